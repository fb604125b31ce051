"""Queries over the driver's tables, each with equivalent SQL."""

from workloads import model_queries, operator_queries, source_queries  # noqa: F401
from workloads.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
