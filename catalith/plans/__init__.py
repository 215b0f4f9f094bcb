"""Queries over the given tables and their SQL twins."""

from catalith.plans.registry import ORACLES, QUERIES
from catalith.plans import entities, ingest, lifecycle, materials, relations, search, streams, topics  # noqa: F401,E402  they register

__all__ = ["ORACLES", "QUERIES"]
