"""Parquet tables and their catalog entries."""
