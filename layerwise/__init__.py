"""Layered (landing -> raw -> silver -> gold -> target) ETL and data quality on Spark."""

__version__ = "0.1.0"
