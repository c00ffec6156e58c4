"""Registered queries with their SQL twins."""

from cardwatch.plans import (  # noqa: F401
    features, lifecycle, models, monitoring, quality, relational, streams, tables,
)
from cardwatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
