"""Territorial open-data analytics as plain PySpark jobs."""

__version__ = "0.1.0"
