"""All registered queries and their checks."""

from outfall.plans import (  # noqa: F401
    queries_drain_table,
    queries_messages,
    queries_placement,
    queries_streams,
)
from outfall.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
