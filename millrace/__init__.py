"""Incremental ingestion on Spark DataFrames: find pending keys, land responses, insert new rows."""
