"""Complaint analytics on Spark: ingestion, keyed upsert, marts, serving frames and checks."""
