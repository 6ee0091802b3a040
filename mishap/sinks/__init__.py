"""Sinks: CSV and Parquet writers (distributed by default)."""
