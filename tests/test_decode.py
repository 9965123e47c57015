import datetime as dt

from pyspark.sql import functions as F

from eventide.functions.decode import MALFORMED, decode_json_struct, parse_events

GOOD = ('{"user_id": 1, "product_id": 1001, "action": "click", '
        '"timestamp": "2025-09-20 10:00:00", "location": "HN"}')


def test_decode_cases(spark):
    rows = [(1, GOOD), (2, "garbage"), (3, '{"user_id":"x","action":"a"}'),
            (4, '{"user_id":2147483648,"action":"a"}'), (5, '{"user_id":1}'), (6, None), (7, "")]
    df = spark.createDataFrame(rows, "id int, value string")
    got = {r["id"]: r["d"] for r in df.select("id", decode_json_struct(F.col("value")).alias("d")).collect()}
    assert got[1]["user_id"] == 1 and got[1]["action"] == "click"
    assert got[2] is not None and all(v is None for v in got[2].asDict().values())
    assert got[3]["user_id"] is None and got[3]["action"] == "a"
    assert got[4]["user_id"] is None and got[4]["action"] == "a"
    assert got[5]["user_id"] == 1 and got[5]["action"] is None
    assert got[6] is None and got[7] is None


def test_parse_drops_or_routes_malformed(spark):
    df = spark.createDataFrame([(GOOD,), ("garbage",), ('{"user_id":1}',), (None,)], "value string")
    assert parse_events(df).count() == 1
    kept = parse_events(df, keep_rejects=True)
    reasons = sorted((r["parse_reason"] or "") for r in kept.collect())
    # a row that only lacks fields is left to the quality rules, which name them
    assert reasons == ["", "", MALFORMED, MALFORMED]


def test_event_time_parsing(spark):
    df = spark.createDataFrame([("2025-09-20 10:00:00",), ("2025-09-20T10:00:00Z",),
                                ("1758362400000",), ("bad",)], "s string")
    got = [r[0] for r in df.select(F.try_to_timestamp("s")).collect()]
    assert got[0] == got[1] == dt.datetime(2025, 9, 20, 10, 0, 0)
    assert got[2] is None and got[3] is None
    ms = spark.range(1).select(F.timestamp_millis(F.lit(1758362400123)).alias("t")).first()["t"]
    assert ms == dt.datetime(2025, 9, 20, 10, 0, 0, 123000)


def test_avro_branch_filter(spark):
    from eventide.functions.decode import avro_branch_filter
    rows = [("click", "Hanoi"), ("click", ""), ("click", None), ("bad", "Hanoi"),
            ("view", "x" * 200), ("view", "x" * 201)]
    df = spark.createDataFrame(rows, "action string, location string")
    kept = [(r["action"], len(r["location"])) for r in df.filter(avro_branch_filter()).collect()]
    assert kept == [("click", 5), ("view", 200)]


def test_avro_time_by_type(spark):
    from eventide.functions.decode import event_time_from_avro
    from pyspark.sql import functions as F
    df = spark.sql("select 1758362400123L as ms, timestamp'2025-09-20 10:00:00.123' as ts")
    for c in ("ms", "ts"):
        got = df.select(F.date_format(event_time_from_avro(F.col(c), dict(df.dtypes)[c]), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
        assert got == "2025-09-20 10:00:00.123"
