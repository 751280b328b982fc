"""Importing this module registers every query."""

from millrace.plans import credit, groups, learned, prepared, rows, scans, streams  # noqa: F401
from millrace.plans.registry import QUERIES, SQL, as_callable

__all__ = ["QUERIES", "SQL", "as_callable"]
