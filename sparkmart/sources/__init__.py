"""Where rows come from: CSV and Parquet extracts, databases, SQL text."""
