"""Batch scans of the driver tables and their mapping onto the event model.

Mapping: ``user_id = events.user_id``, ``product_id = props.k``,
``action = event_type``, ``event_time = ts``; location is the customer's
nation name and user_segment its market segment; device and ip are absent.
The users dimension is customer joined with nation and region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.config import EngineConfig
from eventide.schemas import EVENT_JSON_SCHEMA, JSON_OPTIONS

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_geo(spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> DataFrame:
    """(c_custkey, location, user_segment): customer with its nation name."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .select("c_custkey", F.col("n_name").alias("location"),
                    F.col("c_mktsegment").alias("user_segment")))


def users_from_tables(spark: SparkSession, sf_dir: str, cfg: EngineConfig | None = None) -> DataFrame:
    """Users dimension ``(user_id, name, email, region, created_at)``."""
    cfg = cfg or EngineConfig()
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return (cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey").try_cast("int").alias("user_id"),
                    F.col("c_name").alias("name"),
                    F.lit(None).cast("string").alias("email"),
                    F.col("r_name").alias("region"),
                    F.lit(None).cast("timestamp").alias("created_at")))


def events_from_tables(spark: SparkSession, sf_dir: str, cfg: EngineConfig | None = None,
                       with_geo: bool = True) -> DataFrame:
    """Typed events in the event model, ``event_time`` as TIMESTAMP_NTZ.

    Columns: user_id, product_id, action, timestamp, device_id, device_type,
    location, user_segment, ip_address, event_time.
    """
    cfg = cfg or EngineConfig()
    ev = read_table(spark, sf_dir, "events")
    base = ev.select(
        F.col("user_id").alias("_ukey"),
        F.col("user_id").try_cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("product_id"),
        F.col("event_type").alias("action"),
        F.date_format("ts", TS_TEXT_FORMAT).alias("timestamp"),
        F.col("ts").alias("event_time"),
    )
    if with_geo:
        geo = customer_geo(spark, sf_dir, cfg)
        base = base.join(geo, base._ukey == geo.c_custkey, "left")
        location, segment = F.col("location"), F.col("user_segment")
    else:
        location = segment = F.lit(None).cast("string")
    return base.select(
        "user_id", "product_id", "action", "timestamp",
        F.lit(None).cast("string").alias("device_id"),
        F.lit(None).cast("string").alias("device_type"),
        location.alias("location"), segment.alias("user_segment"),
        F.lit(None).cast("string").alias("ip_address"),
        "event_time",
    )


def json_envelope(events: DataFrame) -> DataFrame:
    """Producer-side view: each event as one JSON ``value`` string, the shape a
    Kafka topic or a JSON-lines file carries."""
    fields = [F.col(f.name) for f in EVENT_JSON_SCHEMA.fields]
    return events.select(F.to_json(F.struct(*fields), JSON_OPTIONS).alias("value"), "event_time")
