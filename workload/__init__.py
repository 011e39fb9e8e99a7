"""Queries over the given tables, each next to the SQL that checks it."""

from workload import columns, jobs, joins, scoring, sources  # noqa: F401  (they register queries)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
