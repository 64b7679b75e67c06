"""Queries over the benchmark tables: one or more per operator, each with its SQL twin."""

from . import coercion, files, incremental, loading, payloads, refusals, shaping, state, windows  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
