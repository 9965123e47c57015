import datetime as dt

from pyspark.sql import functions as F

from eventide.config import EngineConfig
from eventide.functions import quality

AS_OF = dt.datetime(2025, 9, 21, 12, 0, 0)
T0 = dt.datetime(2025, 9, 20, 10, 0, 0)
SCHEMA = "id int, user_id int, product_id int, action string, event_time timestamp, location string"

# FIXTURES.md §2 "Validation": id, row, expected reason (None = valid).
ROWS = [
    ((1, 1, 2, "click", T0, "HN"), None),
    ((2, 1, 2, "click", T0, None), None),
    ((3, None, 2, "click", T0, "HN"), "invalid_user_id"),
    ((4, None, 2, "click", T0, None), "invalid_user_id"),
    ((5, 3, -1, "bad", T0, "x" * 340), "invalid_product_id,invalid_action,location_too_long"),
    ((6, 1, 2, "click", dt.datetime(2099, 1, 1), "HN"), "invalid_event_time"),
    ((7, 1, 2, "click", T0, ""), None),
    ((8, 1, 2, "click", T0, "y" * 200), None),
]


def _df(spark):
    return spark.createDataFrame([r for r, _ in ROWS], SCHEMA)


def test_reasons_per_row(spark):
    got = {r["id"]: r["dq_reason"] for r in
           quality.with_dq_reason(_df(spark), as_of=AS_OF).collect()}
    assert got == {r[0]: reason for r, reason in ROWS}


def test_split_is_total(spark):
    df = _df(spark)
    valid, invalid = quality.split_valid_invalid(df, as_of=AS_OF)
    assert valid.count() == 4 and invalid.count() == 4
    assert valid.count() + invalid.count() == df.count()
    assert "dq_reason" not in valid.columns


def test_reference_case(spark):
    # valid row, NULL user, and one row with three reasons
    df = spark.createDataFrame([
        (1, 2, "click", T0, "HN"), (None, 2, "click", T0, "HN"),
        (3, -1, "invalid_action", T0, "too_long_location" * 20)],
        "user_id int, product_id int, action string, event_time timestamp, location string")
    valid, invalid = quality.split_valid_invalid(df, as_of=AS_OF)
    assert valid.count() == 1
    reasons = sorted(r["dq_reason"] for r in invalid.collect())
    assert reasons[0] == "invalid_product_id,invalid_action,location_too_long"
    assert reasons[1] == "invalid_user_id"


def test_no_action_list_means_not_null(spark):
    cfg = EngineConfig(valid_actions=None)
    df = spark.createDataFrame([(1, 1, "anything", T0, None), (2, 1, None, T0, None)],
                               "user_id int, product_id int, action string, event_time timestamp, location string")
    got = sorted((r["user_id"], r["dq_reason"]) for r in
                 quality.with_dq_reason(df, cfg, AS_OF).collect())
    assert got == [(1, None), (2, "invalid_action")]


def test_env_config_empty_actions():
    cfg = EngineConfig.from_env({"VALID_ACTIONS": ""})
    assert cfg.valid_actions is None
    cfg = EngineConfig.from_env({"VALID_ACTIONS": "a,b", "Z_THRESHOLD": "3"})
    assert cfg.valid_actions == ("a", "b") and cfg.z_threshold == 3.0


def test_profile(spark):
    prof = {r["dq_reason"]: r["n_rows"] for r in
            quality.dq_profile(quality.with_dq_reason(_df(spark), as_of=AS_OF)).collect()}
    assert prof == {"invalid_user_id": 2, "invalid_event_time": 1,
                    "invalid_product_id,invalid_action,location_too_long": 1}


def test_plan_has_no_python_udf(spark):
    df = quality.with_dq_reason(_df(spark), as_of=AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
