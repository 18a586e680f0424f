"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from tenderlake.plans import feed_queries, ops_queries, variety


def queries() -> dict:
    out: dict = {}
    for mod in (feed_queries, ops_queries, variety):
        out.update(mod.queries())
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in (feed_queries, ops_queries, variety):
        out.update(mod.oracles())
    return out
