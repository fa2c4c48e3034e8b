"""Readers: Parquet, JSON, delimited, fixed-width, framed, JDBC, metastore, streams."""
