"""Where rows go: dated Parquet folders, catalog tables, topics."""
