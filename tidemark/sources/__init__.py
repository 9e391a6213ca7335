"""Everything that touches paths: CSV, Parquet tables, fingerprints, work folders."""
