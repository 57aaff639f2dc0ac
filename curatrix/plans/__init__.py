"""Registered queries and their SQL, grouped by subject."""
