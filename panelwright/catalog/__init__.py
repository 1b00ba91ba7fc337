"""Registered queries: a Spark query on the test tables and SQL giving the same rows."""

from __future__ import annotations

from panelwright.catalog import basics, joins, panels, plans, regressions, saved, sketches, summaries  # noqa: F401
from panelwright.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
