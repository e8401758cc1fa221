"""Bindings of every job to the shared test tables, their DuckDB oracle SQL, and plan checks."""
