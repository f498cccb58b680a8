"""Readers and writers of the text and Parquet tables."""
