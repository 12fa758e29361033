"""All registered queries."""

from orderloom.plans import (  # noqa: F401
    queries_forecast,
    queries_listing,
    queries_models,
    queries_quality,
    queries_sources,
    queries_time,
)
from orderloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
