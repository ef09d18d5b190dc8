"""Query plans over the driver tables: derived inputs, registered queries and
their DuckDB oracle SQL."""
