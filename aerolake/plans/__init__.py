"""Plans: catalog tables (star / serving), benchmark and serving SQL, the end-to-end pipeline, and the query
registry with its SQL oracle."""
