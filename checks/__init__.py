"""Queries over the given tables and the SQL that states their results.

Each module registers its own.
"""

from checks import ingest, permutations, significance, trees  # noqa: F401
from checks.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
