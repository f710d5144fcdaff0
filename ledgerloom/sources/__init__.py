"""Readers and writers for lines, JSON, CSV, Parquet splits and models."""
