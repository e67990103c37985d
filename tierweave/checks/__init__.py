"""Every operator bound to the driver tables, with the SQL that must give the same rows."""

from tierweave.checks.registry import ORACLES, QUERIES
from tierweave.checks import aggregates, catalog, functions, listings, matching, merging, payloads, tagging  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
