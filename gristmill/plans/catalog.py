"""Importing this module registers every query."""

from gristmill.plans import catalog_corpus, catalog_ledger, catalog_metrics  # noqa: F401
from gristmill.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
