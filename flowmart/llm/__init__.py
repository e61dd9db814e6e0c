"""Operators for training data at scale; nothing else in the library imports this subpackage."""

from flowmart.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
