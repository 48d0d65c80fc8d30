"""Registered queries: library functions bound to the given tables."""

from tidemark.plans import analytics, learning, loading, relevance, reshape, search, streams, texts  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
