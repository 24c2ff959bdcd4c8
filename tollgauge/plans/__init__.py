"""Registered queries over the given tables."""

from importlib import import_module

MODULES = ("money_queries", "listing_queries", "check_queries", "response_queries",
           "ledger_queries", "answer_queries", "source_queries", "publish_queries")


def all_queries():
    """Import every query module and return (queries, oracle SQL)."""
    for module in MODULES:
        import_module(f"tollgauge.plans.{module}")
    from tollgauge.plans.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
