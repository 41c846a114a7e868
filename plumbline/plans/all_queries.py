"""Imports every query module, which registers its queries."""
from plumbline.plans import (  # noqa: F401
    audit_queries,
    feature_queries,
    model_queries,
    statistics_queries,
    stream_queries,
    twin_queries,
)
from plumbline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
