"""Every operator run over the driver tables, with the SQL that gives the same rows."""

from flowmart.showcase import checks, columns, files, joins, marts, metrics, shape  # noqa: F401  (register)
from flowmart.showcase.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
