"""All registered queries and their oracles."""

from __future__ import annotations

from tidewater.plans import clickstream, clickstream_sql, curation, curation_sql, orders, orders_sql, streams, streams_sql


def all_queries() -> dict:
    out = {}
    out.update(clickstream.QUERIES)
    out.update(curation.QUERIES)
    out.update(orders.QUERIES)
    out.update(streams.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    out.update(clickstream_sql.SQL)
    out.update(curation_sql.SQL)
    out.update(orders_sql.SQL)
    out.update(streams_sql.SQL)
    return out
