"""Registered queries over the driver tables, each with its SQL check where SQL can express it."""

from importlib import import_module

MODULES = ["receipts", "facts", "outcomes", "crawl", "followups", "streams"]


def load():
    from driver_queries.base import ORACLES, QUERIES

    for name in MODULES:
        import_module(f"driver_queries.{name}")
    return dict(QUERIES), dict(ORACLES)
