"""Readers: files, archives and documents to DataFrames."""
