"""Landed pages, raw JSON lines, typed Parquet and the warehouse table."""
