"""All registered queries; importing the modules fills the two tables."""

from riskweave.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "load"]


def load():
    from riskweave.catalog import digits, governance_queries, graphs, ingest, jobs, mart_queries, texts  # noqa: F401

    return QUERIES, ORACLE
