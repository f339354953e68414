"""Registered queries: each binds library operators to the driver tables and
carries, where SQL can express it, an equivalent DuckDB oracle."""
