from panelkit.sources.io import load_table, read_csv, read_many, write_csv, write_parquet  # noqa: F401
