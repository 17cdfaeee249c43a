"""All registered queries."""

from taxaloom.plans import (  # noqa: F401
    queries_composition,
    queries_diversity,
    queries_functional,
    queries_io,
    queries_tables,
    queries_tests,
)
from taxaloom.plans.register import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
