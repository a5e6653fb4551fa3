"""Imports every module that registers queries."""

from __future__ import annotations

from simlane.plans import recommend_queries, rollup_queries, sequence_queries, source_queries, text_queries  # noqa: F401
from simlane.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
