"""Batch and streaming operators for social-network tables, as Spark DataFrame plans."""

__version__ = "0.1.0"
