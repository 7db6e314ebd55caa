"""Registered queries over the driver's tables, each beside the SQL that checks it."""

from __future__ import annotations

from sediment.queries import aggregates, arrivals, landed, merges, price_feed, runs

MODULES = (aggregates, merges, landed, price_feed, runs, arrivals)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
