"""Independent DuckDB SQL statements of every registered query (the oracle)."""

from duck_oracle.sql import oracle_queries  # noqa: F401
