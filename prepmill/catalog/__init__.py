"""Registered queries: each capability on the test tables, with SQL for its expected result."""

from prepmill.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    conditionals,
    evaluation,
    features,
    filters,
    jobs,
    missing,
    models,
    movement,
    ordering,
    profiles,
    projections,
    splits,
)
from prepmill.catalog.registry import ENTRIES

__all__ = ["ENTRIES"]
