"""Retail order analytics on Spark: ingest, clean, version, join in time, report."""
