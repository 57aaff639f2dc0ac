"""Spark-first engine for curating question-reasoning-answer data at scale."""

__version__ = "0.1.0"
