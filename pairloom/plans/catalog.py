"""All queries of the engine and their SQL."""

from __future__ import annotations

from pairloom.plans import dispatch, engine, extras, files, pixels, relational, widen  # noqa: F401  all register their queries
from pairloom.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
