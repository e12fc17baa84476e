"""Registered queries over the driver's tables, and their SQL twins."""

from suite import load, money, persona, scoring, streams, tables  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
