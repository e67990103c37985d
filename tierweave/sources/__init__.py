"""Reading and writing catalogs, and mapping landed payloads to records."""
