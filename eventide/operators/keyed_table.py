"""A lasting keyed table: a versioned base plus the batches it does not hold yet.

The change log (``changelog``) has a folder for each micro-batch. ``fold`` merges
the batches it finds into a new version of the base and records in the manifest
exactly which batch ids that version holds; a reader takes the base and every
complete batch that is not listed. A batch that lands during a fold, or late with
a lower id, is therefore read from the log until a later fold lists it; none is
lost, and none counts twice.

The base is divided by ``part``, an expression over the key columns (a window's
date). A fold rewrites only the parts its new batches touch, and a read merges
only those of the unlisted batches: the rest of the base passes unshuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.changelog import batch_path, complete_batches, first_by_key, latest_by_key
from eventide.operators.manifest import ManifestLog, ranges, within

#: Version folders a table may consist of before a fold rewrites all of it.
MAX_VERSIONS = 24
_PART = "_part"


class KeyedTable:
    def __init__(self, spark: SparkSession, log_path: str, base_path: str, key_cols: Sequence[str], keep: str = "latest",
                 order_cols: Sequence[str] = ("batch_id",), part: str | None = None):
        """``keep``: ``latest`` (upsert) or ``first`` (insert-ignore) by ``order_cols``;
        ``part``: SQL expression over the key columns that divides the base."""
        if keep not in ("latest", "first"):
            raise ValueError("keep must be 'latest' or 'first'")
        self.spark, self.log_path, self.base_path = spark, log_path.rstrip("/"), base_path.rstrip("/")
        self.key_cols, self.order_cols, self.keep = list(key_cols), tuple(order_cols), keep
        # a letter in front keeps the folder name text, whatever it looks like
        self._part = F.concat(F.lit("p"), F.coalesce(F.expr(part).cast("string"), F.lit(""))) if part else F.lit("p")
        self.manifests = ManifestLog(spark, f"{self.base_path}/manifests")

    # --- what there is ---------------------------------------------------------

    def manifest(self) -> dict:
        return self.manifests.latest() or {"version": 0, "batches": [], "parts": {}}

    def tail(self, manifest: dict | None = None) -> list[int]:
        """Complete batches that the manifest does not list."""
        held = (manifest or self.manifest())["batches"]
        return [b for b in complete_batches(self.spark, self.log_path) if not within(held, b)]

    def _batches(self, ids: Sequence[int]) -> DataFrame:
        rows = self.spark.read.option("basePath", self.log_path).parquet(*[batch_path(self.log_path, b) for b in ids])
        return rows.withColumn(_PART, self._part)

    def _base(self, parts: dict[str, int]) -> DataFrame | None:
        """The named parts, each from the version that holds it; other folders are pruned."""
        by_version: dict[int, list[str]] = {}
        for part, version in parts.items():
            by_version.setdefault(version, []).append(part)
        reads = [self.spark.read.parquet(f"{self.base_path}/version={v}").filter(F.col(_PART).isin(ps))
                 for v, ps in sorted(by_version.items())]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reads) if reads else None

    def _merged(self, new: DataFrame, old: DataFrame | None) -> DataFrame:
        rows = new if old is None else new.unionByName(old, allowMissingColumns=True)
        pick = latest_by_key if self.keep == "latest" else first_by_key
        return pick(rows, [*self.key_cols, _PART], self.order_cols)

    @staticmethod
    def _touched(rows: DataFrame) -> list[str]:
        """The parts of the rows; as many as the table has windows' dates at most."""
        return sorted(r[0] for r in rows.select(_PART).distinct().collect())

    # --- use -------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.manifest()["batches"] or self.tail())

    def read(self) -> DataFrame | None:
        """The table now: base and unlisted batches; None where there is nothing."""
        manifest = self.manifest()
        tail, parts = self.tail(manifest), manifest["parts"]
        if not tail:
            base = self._base(parts)
            return None if base is None else base.drop(_PART)
        new = self._batches(tail)
        touched = set(self._touched(new))
        merged = self._merged(new, self._base({p: v for p, v in parts.items() if p in touched}))
        rest = self._base({p: v for p, v in parts.items() if p not in touched})
        out = merged if rest is None else merged.unionByName(rest, allowMissingColumns=True)
        return out.drop(_PART)

    def read_version(self, version: int) -> DataFrame | None:
        """The base as a version had it."""
        doc = self.manifests.read(version)
        base = self._base(doc["parts"]) if doc else None
        return None if base is None else base.drop(_PART)

    def fold(self) -> dict | None:
        """Merge the unlisted batches into a new version; its manifest, or None where
        there was nothing to do. Batches that arrive meanwhile stay unlisted."""
        manifest = self.manifest()
        ids, parts = self.tail(manifest), manifest["parts"]
        if not ids:
            return None
        new = self._batches(ids)
        touched = self._touched(new)
        whole = len({*parts.values()}) >= MAX_VERSIONS
        old = self._base(parts if whole else {p: v for p, v in parts.items() if p in set(touched)})
        taken = [int(p.rsplit("=", 1)[1]) for p in self.manifests.glob(f"{self.base_path}/version=*")]
        version = max([manifest["version"], *self.manifests.versions(), *taken], default=0) + 1
        # rebalancing by part makes few files of small parts and several of a large one
        (self._merged(new, old).hint("rebalance", _PART)
         .write.mode("errorifexists").partitionBy(_PART).parquet(f"{self.base_path}/version={version}"))
        rewritten = [*parts, *touched] if whole else touched
        doc = {"batches": ranges([*(i for a, b in manifest["batches"] for i in range(a, b + 1)), *ids]),
               "parts": {**parts, **{p: version for p in rewritten}}, "folded": ids, "rewritten": sorted(set(rewritten))}
        self.manifests.commit(version, doc)
        return {**doc, "version": version}
