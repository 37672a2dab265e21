"""Where rows come from and go to: the catalog, the Parquet store and raw payloads."""
