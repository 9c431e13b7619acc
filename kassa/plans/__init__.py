"""Composite jobs (batch load, notebook trend analysis) and the query
registry with its DuckDB oracle."""
