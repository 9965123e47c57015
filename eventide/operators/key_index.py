"""Uniqueness of a key across micro-batches: an index of the keys accepted so far.

Each batch adds a folder with its keys and one with a Bloom filter of them, kept
as bitmaps: a key belongs to one of ``buckets`` bitmaps of 32,768 bits and sets
``hashes`` bits of it, so a filter is a few thousand small rows that merge by
``bitmap_or_agg``. A new batch looks its distinct keys up in the filters first;
only the keys that may be known are looked up in the index itself, which
is then joined with a small set instead of being shuffled. ``fold`` gathers the
folders of many batches into one segment, listed in a manifest.

Keys with a null never clash (SQL UNIQUE). Of equal keys within a batch the
smallest row stays. Rows that are equal in every column are counted before they
are joined, so copies of one row never meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.operators.changelog import append_batch, batch_path, complete_batches
from eventide.operators.manifest import ManifestLog, ranges, within
from eventide.schemas import RAW_KEY

#: Copies of a row that are written out at a time.
COPIES = 10_000
#: Bits of a bitmap, as ``bitmap_construct_agg`` has them.
BITMAP_BITS = 32_768


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key_cols: Sequence[str] = RAW_KEY, buckets: int = 1024, hashes: int = 3):
        """About ``buckets`` x 3,000 keys keep the filter's error below 2 %; beyond that it
        lets more keys through to the exact check, and answers stay right."""
        self.spark, self.path = spark, path.rstrip("/")
        self.key_cols, self.buckets, self.hashes = list(key_cols), buckets, hashes
        self.manifests = ManifestLog(spark, f"{self.path}/manifests")

    # --- expressions -------------------------------------------------------------

    def _hash(self, salt: int) -> Column:
        return F.xxhash64(*[F.col(c).cast("string") for c in self.key_cols], F.lit(salt))

    def _bucket(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.buckets)).cast("int")

    def _bits(self) -> list[Column]:
        return [F.pmod(self._hash(j + 1), F.lit(BITMAP_BITS)) for j in range(self.hashes)]

    def has_key(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.key_cols])

    @staticmethod
    def _is_set(bitmap: Column, bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    # --- folders ------------------------------------------------------------------

    def manifest(self) -> dict:
        return self.manifests.latest() or {"version": 0, "batches": [], "segments": []}

    def _read(self, kind: str, manifest: dict, below: int | None = None) -> DataFrame | None:
        """Keys or filters of all segments and of the complete batches outside them."""
        log = f"{self.path}/{kind}"
        tail = [b for b in self._complete() if not within(manifest["batches"], b) and (below is None or b < below)]
        parts = [self.spark.read.parquet(f"{self.path}/segments/{kind}/version={v}") for v in manifest["segments"]]
        if tail:
            parts.append(self.spark.read.option("basePath", log).parquet(*[batch_path(log, b) for b in tail]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _complete(self) -> list[int]:
        """Batches whose filter is there: it is written after the keys."""
        return complete_batches(self.spark, f"{self.path}/filters")

    # --- use ------------------------------------------------------------------------

    def known(self, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """The distinct keys of ``rows`` that earlier batches hold; None where there are none."""
        manifest = self.manifest()
        filters, keys = self._read("filters", manifest, batch_id), self._read("keys", manifest, batch_id)
        if filters is None:
            return None
        merged = filters.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        asked = (rows.filter(self.has_key()).select(*self.key_cols).dropDuplicates()
                 .withColumn("bucket", self._bucket()))
        maybe = asked.join(merged, "bucket")
        for bit in self._bits():
            maybe = maybe.filter(self._is_set(F.col("bits"), bit))
        maybe = maybe.select("bucket", *self.key_cols)
        # a segment may hold this very batch (a replay) or later ones
        earlier = keys.filter(F.col("batch_id") < batch_id).select("bucket", *self.key_cols)
        return earlier.join(maybe, ["bucket", *self.key_cols], "left_semi").select(*self.key_cols).dropDuplicates()

    def mark(self, rows: DataFrame, batch_id: int, flag: str = "key_clash") -> DataFrame:
        """All rows with a flag: true where an earlier batch or a row of this batch has the key."""
        columns, others = rows.columns, [c for c in rows.columns if c not in self.key_cols]
        counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        free = counted.filter(~self.has_key()).withColumn("_kept", F.col("_n"))
        keyed = counted.filter(self.has_key())
        rest = F.struct(*[F.col(c) for c in others]) if others else F.lit(0)
        first = keyed.groupBy(*self.key_cols).agg(F.min(rest).alias("_first"))
        known = self.known(rows, batch_id)
        if known is None:
            first = first.withColumn("_known", F.lit(False))
        else:
            first = first.join(known.withColumn("_known", F.lit(True)), self.key_cols, "left")
        held = (keyed.join(first, self.key_cols)
                .withColumn("_kept", F.when(F.col("_known").isNull() | ~F.col("_known"),
                                            (rest.eqNullSafe(F.col("_first"))).cast("long")).otherwise(F.lit(0).cast("long"))))
        both = held.select(*columns, "_n", "_kept").unionByName(free.select(*columns, "_n", "_kept"))
        # each counted row comes back as often as it was there, a bounded piece at a time
        pieces = both.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))))
        last = F.least(F.col("_from") + COPIES, F.col("_n")) - 1
        numbered = pieces.withColumn("_copy", F.explode(F.sequence("_from", last)))
        return numbered.select(*columns, (F.col("_copy") >= F.col("_kept")).alias(flag))

    def add(self, accepted: DataFrame, batch_id: int) -> None:
        """Record the keys of a batch's accepted rows; a replay replaces them."""
        keys = accepted.filter(self.has_key()).select(*self.key_cols).withColumn("bucket", self._bucket())
        append_batch(keys, f"{self.path}/keys", batch_id)
        append_batch(self._filter(keys), f"{self.path}/filters", batch_id)

    def _filter(self, keys: DataFrame) -> DataFrame:
        bits = keys.select("bucket", F.explode(F.array(*self._bits())).alias("bit"))
        return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def fold(self) -> dict | None:
        """Gather the batches outside the segments into a new one, its keys in bucket order."""
        manifest = self.manifest()
        ids = [b for b in self._complete() if not within(manifest["batches"], b)]
        if not ids:
            return None
        taken = [int(p.rsplit("=", 1)[1]) for p in self.manifests.glob(f"{self.path}/segments/*/version=*")]
        version = max([manifest["version"], *self.manifests.versions(), *taken], default=0) + 1

        def rows(kind):
            log = f"{self.path}/{kind}"
            return self.spark.read.option("basePath", log).parquet(*[batch_path(log, b) for b in ids])

        rows("keys").repartitionByRange("bucket").sortWithinPartitions("bucket").write.parquet(f"{self.path}/segments/keys/version={version}")
        (rows("filters").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
         .write.parquet(f"{self.path}/segments/filters/version={version}"))
        held = [*(i for a, b in manifest["batches"] for i in range(a, b + 1)), *ids]
        doc = {"batches": ranges(held), "segments": [*manifest["segments"], version], "folded": ids}
        self.manifests.commit(version, doc)
        return {**doc, "version": version}
