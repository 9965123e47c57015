"""Decode the raw ``value`` envelope into typed events (JSON or Avro).

Notes on Spark 4 semantics the chain depends on:
- ``from_json`` makes every field nullable and turns a garbage string into a
  struct of NULLs (only NULL/empty input yields NULL), so required fields need
  an explicit check.
- ``to_timestamp`` raises on bad input under ANSI mode; ``try_to_timestamp``
  returns NULL instead.
- ``withWatermark`` needs TIMESTAMP (not TIMESTAMP_NTZ) event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventide.config import EngineConfig
from eventide.schemas import EVENT_JSON_SCHEMA, JSON_OPTIONS, REQUIRED_COLS

MALFORMED = "malformed_record"


def avro_available(spark=None) -> bool:
    """True when spark-avro is usable: the Python wrapper imports and the JVM
    expression class is on the classpath."""
    try:
        from pyspark.sql import SparkSession
        from pyspark.sql.avro.functions import from_avro  # noqa: F401
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            return False
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:  # noqa: BLE001
        return False
    return True


def decode_json_struct(value: Column, schema=EVENT_JSON_SCHEMA) -> Column:
    """``value`` (string or binary) → struct, NULL when the input is NULL/empty."""
    return F.from_json(value.cast("string"), schema, JSON_OPTIONS)


def decode_avro_struct(value: Column, schema_json: str, framed: bool = False) -> Column:
    """Avro payload → struct. ``framed`` skips the 5-byte registry header
    (magic byte + 4-byte schema id) that registry serializers prepend."""
    from pyspark.sql.avro.functions import from_avro
    payload = F.expr("substring(value, 6)") if framed else value
    return from_avro(payload, schema_json, {"mode": "PERMISSIVE"})


def event_time_from_string(c: Column) -> Column:
    return F.try_to_timestamp(c)


def event_time_from_millis(c: Column) -> Column:
    return F.timestamp_millis(c.cast("long"))


def event_time_from_avro(c: Column, kind: str) -> Column:
    """A decoded timestamp field: epoch millis as a plain long, or already a
    timestamp where the writer schema's logical type was understood."""
    return c.cast("timestamp") if kind.startswith("timestamp") else event_time_from_millis(c)


def required_present(cols=REQUIRED_COLS) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def location_in_bounds(max_len: int) -> Column:
    """Location length within 1..max_len (the intent of the Avro-branch filter)."""
    return F.length("location").between(1, max_len)


def avro_branch_filter(cfg: EngineConfig | None = None) -> Column:
    """Extra filters of the Avro branch: allowed action and a location of
    1..max characters (a NULL location fails, as a pattern match would)."""
    cfg = cfg or EngineConfig()
    action_ok = F.col("action").isin(*cfg.valid_actions) if cfg.valid_actions \
        else F.col("action").isNotNull()
    return F.coalesce(action_ok, F.lit(False)) & \
        F.coalesce(location_in_bounds(cfg.max_location_len), F.lit(False))


def parse_events(raw: DataFrame, cfg: EngineConfig | None = None, fmt: str = "json",
                 avro_schema: str | None = None, framed: bool = False,
                 keep_rejects: bool = False, carry: tuple[str, ...] = (),
                 fields: tuple[str, ...] | None = None) -> DataFrame:
    """The parse stage: decode → drop undecodable → flatten → event time →
    require fields (→ Avro-branch allowed-value and location filters).

    With ``keep_rejects`` nothing is dropped; a ``parse_reason`` column marks
    rows of which nothing could be decoded (``malformed_record``), and those the
    Avro branch filters out, so they can be dead-lettered; rows that only lack
    a required field are left to the quality rules, which name it.
    ``fields`` (JSON): decode these fields only; the others are not in the result.
    Source columns named in ``carry`` (e.g. Kafka ``partition``, ``offset``)
    are kept with a ``source_`` prefix, so they never collide with event fields.
    """
    cfg = cfg or EngineConfig()
    extra = list(carry)
    if fmt == "json":
        wanted = [f for f in EVENT_JSON_SCHEMA.fields if fields is None or f.name in fields]
        data = decode_json_struct(F.col("value"), T.StructType(wanted))
    elif fmt == "avro":
        if not avro_available(raw.sparkSession):
            raise RuntimeError("spark-avro is not available; cannot decode Avro")
        if avro_schema is None:
            raise ValueError("Avro decoding needs the writer schema string")
        data = decode_avro_struct(F.col("value"), avro_schema, framed)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    # a one-row explode: filters stay above it, so a value is decoded once and not anew for each condition
    df = raw.select(F.explode(F.array(data)).alias("data"), F.col("value").cast("string").alias("_raw"),
                    *[F.col(c).alias(f"_src_{c}") for c in extra])
    names = [f.name for f in EVENT_JSON_SCHEMA.fields if fmt == "avro" or fields is None or f.name in fields]
    ts = F.col("data.timestamp")
    event_time = event_time_from_avro(ts, df.select(ts).dtypes[0][1]) if fmt == "avro" else event_time_from_string(ts)
    if fmt == "avro":
        # the raw sink's timestamp column is a timestamp text, not epoch millis
        ts_text = F.date_format(event_time, "yyyy-MM-dd HH:mm:ss.SSS")
    else:
        ts_text = ts
    flat = df.select(
        *[(ts_text if n == "timestamp" else F.col(f"data.{n}")).alias(n) for n in names],
        event_time.alias("event_time"),
        F.col("data").isNull().alias("_undecodable"),
        "_raw",
        *[F.col(f"_src_{c}").alias(f"source_{c}") for c in extra],
    )
    ok = ~F.col("_undecodable") & required_present()
    if keep_rejects:
        bad = F.col("_undecodable") | ~F.greatest(*[F.col(n).isNotNull() for n in names])
        if fmt == "avro":
            bad = bad | (ok & ~avro_branch_filter(cfg))
        return flat.withColumn("parse_reason", F.when(bad, F.lit(MALFORMED))).drop("_undecodable")
    if fmt == "avro":
        ok = ok & avro_branch_filter(cfg)
    return flat.filter(ok).drop("_undecodable", "_raw")
