"""Query catalog: each key pairs a Spark plan with its DuckDB oracle SQL."""
