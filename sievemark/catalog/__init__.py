"""Every operator as a named query over the supplied tables."""

from sievemark.catalog import (  # noqa: F401
    categories, chart_queries, cleaning, damage, feedback_queries, io_queries, modelling, quality,
    row_queries, statistics, stream_queries,
)
from sievemark.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
