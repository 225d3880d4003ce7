"""The reports, their end-to-end jobs, the registered queries and their DuckDB oracle."""
