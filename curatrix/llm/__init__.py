"""Operators for training text of language models; nothing outside this subpackage imports it."""
