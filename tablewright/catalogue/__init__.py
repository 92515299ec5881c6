"""Queries over the given tables, one or more for each operator, and the SQL that gives the same rows."""

from tablewright.catalogue import derived, layouts, logs, partitioned, reading, scalar, tables
from tablewright.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "derived", "layouts", "logs", "partitioned", "reading", "scalar", "tables"]
