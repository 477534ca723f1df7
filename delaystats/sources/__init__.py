"""Inputs and storage: CSV, keyed Parquet layouts, the test table."""
