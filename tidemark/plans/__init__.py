"""The query catalogue."""

from tidemark.plans import (  # noqa: F401  (importing registers the queries)
    aggregates,
    emits,
    exports,
    expressions,
    fanout,
    imports,
    joins,
    keyed,
    reports,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
