"""Queries over the shared test tables, each with its SQL twin where SQL can say it."""

from homeledger.catalog import (  # noqa: F401
    function_queries, source_queries, aggregate_queries, model_queries)
from homeledger.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
