"""Spark-first engine for curating short news records into deduplicated topic reports."""

__version__ = "0.1.0"
