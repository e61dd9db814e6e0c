"""Mart jobs."""

from flowmart.plans import jobs

__all__ = ["jobs"]
