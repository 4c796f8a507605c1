"""Tidemark: a daily observation lakehouse written as plain Spark DataFrame operators."""

__version__ = "0.1.0"
