"""Parquet export of results, with a manifest."""
