"""Plan shape: the properties that keep the queries fast at scale."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from eventide.plans.registry import registered_queries
from eventide.operators import changelog, windows

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_events(spark, n=3000):
    """user 1 holds a third of all rows; the rest spread over 500 users."""
    base = dt.datetime(2025, 1, 1)
    rows = [(1 if i % 3 == 0 else 2 + i % 500, base + dt.timedelta(seconds=i % 600), "click", None)
            for i in range(n)]
    return spark.createDataFrame(rows, "user_id int, event_time timestamp, action string, device_id string")


def test_window_count_partial_aggregates_before_shuffle(spark):
    plan = _plan(windows.summary(_hot_events(spark), "1 minute", "5 seconds"))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")  # partial is below


def test_hot_key_results_match_brute_force(spark):
    ev = _hot_events(spark)
    got = {(r["window_start"], r["user_id"]): r["event_count"]
           for r in windows.summary(ev, "1 minute").collect()}
    pdf = ev.toPandas()
    pdf["w"] = pdf["event_time"].dt.floor("60s")
    want = pdf.groupby(["w", "user_id"]).size().to_dict()
    assert {(k[0].to_pydatetime(), k[1]): v for k, v in want.items()} == got


def test_views_and_dedup_aggregate_map_side(spark):
    ev = _hot_events(spark).withColumn("batch_id", F.lit(1))
    latest = changelog.latest_by_key(ev, ["user_id"])
    assert "partial_max_by" in _plan(latest)
    dd = changelog.dedup_rows(ev.withColumn("device_id", F.lit("d")), ["user_id", "event_time", "device_id"])
    p = _plan(dd)
    assert "partial_first" in p or "HashAggregate" in p


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["tumbling_5s"](spark, SF_SMALL)
    plan = _plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", sorted(set(registered_queries()) - {"kmeans_train_score"}
                                        - {n for n in registered_queries() if n.startswith("stream_")}))
def test_no_python_evaluation_in_registered_plans(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_session_enables_aqe_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
