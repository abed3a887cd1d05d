"""Readers and writers: batch CSV files, the Parquet store, result exports."""
