"""Writers: replacing slices of partitioned Parquet tables, and plain files."""
