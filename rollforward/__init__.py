"""Incremental ingestion, change feeds and latest-date rollups on Spark DataFrames."""
