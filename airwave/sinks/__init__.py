"""Outputs: tab-separated text and Parquet tables."""
