"""All registered queries and their oracle SQL."""

from __future__ import annotations

from workload import import_queries, runner_queries, series_queries, table_queries

_AREAS = (import_queries, series_queries, table_queries, runner_queries)

QUERIES = {name: q for area in _AREAS for name, q in area.QUERIES.items()}
ORACLE = {name: sql for area in _AREAS for name, sql in area.ORACLE.items()}
