"""Streaming sources. Each returns a DataFrame with a ``value`` column (string
or binary), the one contract every decoder reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.config import EngineConfig


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka connector is on the classpath."""
    try:
        spark._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def kafka_source(spark: SparkSession, brokers: str, topic: str,
                 cfg: EngineConfig | None = None, starting_offsets: str = "earliest",
                 fail_on_data_loss: bool = False, extra: dict | None = None) -> DataFrame:
    """Kafka topic scan: earliest offsets, tolerate data loss, rate-limited per trigger if configured."""
    cfg = cfg or EngineConfig()
    if not kafka_available(spark):
        raise RuntimeError("Kafka connector (spark-sql-kafka) is not on the classpath")
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if cfg.max_offsets_per_trigger is not None:
        r = r.option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load()


def file_source(spark: SparkSession, path: str, fmt: str = "text",
                max_files_per_trigger: int | None = None, schema=None) -> DataFrame:
    """File stream with the same contract: JSON lines as ``value`` text, or a
    parquet/json directory with a ``value`` column."""
    r = spark.readStream.format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if "value" not in df.columns:
        raise ValueError(f"stream at {path} has no 'value' column: {df.columns}")
    return df


def write_json_lines(df: DataFrame, path: str, value_col: str = "value",
                     partitions: int | None = None) -> None:
    """Write a ``value`` string column as JSON-lines text files: a topic
    stand-in with ``partitions`` files (default: the cluster's parallelism),
    rows spread round-robin as a producer spreads messages over partitions."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    (df.select(F.col(value_col).alias("value")).repartition(n)
       .write.mode("overwrite").text(path))
