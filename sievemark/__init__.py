"""Tabular data quality as Spark jobs: load, infer, clean, profile, check, score."""

__version__ = "0.1.0"
