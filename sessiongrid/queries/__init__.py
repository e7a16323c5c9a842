"""Queries over the driver's tables, each with equivalent SQL where SQL can say it."""

from . import features, reports, rules, universe

MODULES = (features, rules, universe, reports)


def all_queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def all_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
