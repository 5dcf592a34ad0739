"""Loads every query module; the registries are complete after this import."""

from placetime.plans import (  # noqa: F401
    event_queries, geo_queries, keyed_queries, prep_queries, spatial_queries, stats_queries, text_queries,
)
from placetime.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
