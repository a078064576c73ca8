"""Independent SQL for every query: plain pair joins and textbook cleaning, for DuckDB."""
