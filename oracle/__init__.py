"""Independent DuckDB statements of what the registered queries compute."""
