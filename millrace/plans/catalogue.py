"""All queries of the library, by name, with DuckDB SQL for the same rows where SQL can express them."""

from __future__ import annotations

from . import query_data, query_dedup, query_eval, query_registry, query_runs, query_text  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
