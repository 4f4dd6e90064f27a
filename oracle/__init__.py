"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from .sql import ORACLE_SQL  # noqa: F401
