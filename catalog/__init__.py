"""The registered queries, their inputs derived from the driver's tables, and their DuckDB twins."""
