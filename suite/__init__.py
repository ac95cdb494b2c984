"""The registered queries and their DuckDB counterparts."""

from suite import commits, decoding, defects, domains, metrics, routing, rules, streams, summaries, tables  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
