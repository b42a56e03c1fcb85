"""Readers: landed payloads, files and tables to DataFrames."""
