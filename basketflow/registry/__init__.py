"""Registered queries and their SQL twins."""

from basketflow.registry import ranking, rows, summaries, tables  # noqa: F401 - they register themselves
from basketflow.registry.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
