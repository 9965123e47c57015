"""Every registered query against its SQL oracle on the smallest tables."""

import hashlib
import os

import pytest

import __spark_entry__ as E
from eventide.plans.registry import registered_oracles, registered_queries
from tools.check_oracles import TABLES, digest

from conftest import SF_SMALL

ROWS_ONLY = {"kmeans_train_score"}


def test_every_query_has_an_oracle_or_is_rows_only():
    q, sql = registered_queries(), registered_oracles()
    assert set(q) - set(sql) == ROWS_ONLY
    assert set(sql) <= set(q)
    assert set(q) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["window_start", "window_end", "user_id", "user_name", "region",
                          "event_count", "score", "severity"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registered_oracles()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    rel = duck.sql(E.oracle_sql()[name])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows) == digest(dcols, drows)


@pytest.mark.parametrize("name", ["summary_upsert_latest", "dlq_json", "tumbling_1h",
                                  "anomaly_zscore_by_window_1h", "text_export"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        srows, scols = [tuple(r) for r in df.collect()], df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    rel = duck.sql(E.oracle_sql()[name])
    assert digest(scols, srows) == digest(rel.columns, rel.fetchall())
