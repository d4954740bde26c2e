"""Writers: Parquet datasets, catalog and database tables, ordered loads."""
