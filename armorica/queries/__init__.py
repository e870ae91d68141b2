"""Every operator as a query over the test tables, each with equivalent SQL."""

from armorica.queries import checking, cleaning, facts, files, plans, reshaping, scoring, statistics  # noqa: F401
from armorica.queries.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
