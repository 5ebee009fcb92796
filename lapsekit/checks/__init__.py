"""Independent checks: DuckDB oracle SQL for the driver tables."""
