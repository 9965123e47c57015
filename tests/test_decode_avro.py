import pytest

from eventide.functions.decode import avro_available, parse_events


def test_avro_is_gated(spark):
    df = spark.createDataFrame([(b"\x00",)], "value binary")
    if avro_available(spark):
        pytest.skip("spark-avro present; gating not exercised")
    with pytest.raises(RuntimeError):
        parse_events(df, fmt="avro", avro_schema="{}")
