"""Driver contract: entry, registered queries and oracles."""

import duckdb

import __spark_entry__ as E
from tests.conftest import SF001

ROWS_ONLY = {"approx_users"}  # approximate distinct: no value oracle


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"event_type", "hour", "minute", "event_count"} <= set(df.columns)


def test_every_query_has_an_oracle_or_is_rows_only():
    qs, sq = E.queries(), E.oracle_sql()
    assert set(sq) <= set(qs)
    assert set(qs) - set(sq) - set(E.LLM_QUERIES) == ROWS_ONLY


def test_oracles_run_in_duckdb():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.sql(sql).fetchall()


def test_cheap_queries_match_oracle_on_smoke_data(spark):
    con = duckdb.connect()
    for t in ("region nation customer part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name in ["business_metrics", "gap_sessions", "quality_report", "stock_check", "top_articles"]:
        sdf = E.queries()[name](spark, SF001)
        cols = sorted(sdf.columns)
        got = sorted(tuple(r[c] for c in cols) for r in sdf.collect())
        rel = con.sql(E.oracle_sql()[name])
        want = sorted(tuple(dict(zip(rel.columns, row))[c] for c in cols) for row in rel.fetchall())
        assert got == want, name
