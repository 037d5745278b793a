"""Declarative XML ingestion on Spark: mapping -> records -> checked, typed table rows -> upsert."""
