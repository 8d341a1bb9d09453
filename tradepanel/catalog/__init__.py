"""Registered queries: each operator over the given tables, with its SQL check."""

from . import aggregates, cleaning, features, files, learning, loads, ordering, panel, quality  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
