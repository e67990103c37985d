"""Operators for building training corpora; nothing else in the library imports them."""

from tierweave.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
