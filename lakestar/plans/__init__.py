"""Queries on the given tables. Importing the modules fills the registry."""

from lakestar.plans import activity, audit, basics, modeling, olap, rental  # noqa: F401
from lakestar.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
