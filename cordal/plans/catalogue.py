"""All queries of the core and their DuckDB counterparts."""

from __future__ import annotations

from cordal.plans import layouts, linking, parsing, processing, runs, staged, texts
from cordal.plans.linking import episodes_per_patient  # noqa: F401  (flagship of the entry point)
from cordal.plans.registry import Query

_PARTS = [linking.registry, texts.registry, parsing.registry, runs.registry, staged.registry, processing.registry, layouts.registry]


def queries() -> dict[str, Query]:
    return {name: f for part in _PARTS for name, f in part.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.sql.items()}
