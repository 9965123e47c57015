"""Compaction of a streaming file sink's archive.

A streaming sink writes some files for each micro-batch and date. ``compact`` merges
the small files of closed dates into few, clustered by user, beside the archive,
and lists in a manifest exactly which files they replace. The sink's own log of
committed files stays untouched, so the stream goes on; readers take the merged
files and those committed files that no manifest lists. What a failed batch left
behind is in neither.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.manifest import ManifestLog


class Archive:
    def __init__(self, spark: SparkSession, path: str, merged_path: str | None = None, date_col: str = "event_date",
                 cluster_col: str = "user_id"):
        self.spark, self.path = spark, path.rstrip("/")
        self.merged_path = (merged_path or f"{self.path}_merged").rstrip("/")
        self.date_col, self.cluster_col = date_col, cluster_col
        self.manifests = ManifestLog(spark, f"{self.merged_path}/manifests")

    def manifest(self) -> dict:
        return self.manifests.latest() or {"version": 0, "replaced": [], "dates": {}}

    def committed(self) -> list[str]:
        """Files that the sink has committed (Spark reads its log, not the folder)."""
        return sorted(unquote(f) for f in self.spark.read.parquet(self.path).inputFiles())

    def _date_of(self, file: str) -> str:
        return next(p.split("=", 1)[1] for p in file.split("/") if p.startswith(f"{self.date_col}="))

    def _files(self, files: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(*files)

    def _merged(self, dates: dict[str, int]) -> list[DataFrame]:
        by_version: dict[int, list[str]] = {}
        for date, version in dates.items():
            by_version.setdefault(version, []).append(date)
        return [self.spark.read.parquet(f"{self.merged_path}/version={v}").filter(F.col(self.date_col).cast("string").isin(ds))
                for v, ds in sorted(by_version.items())]

    def open_files(self, manifest: dict | None = None) -> list[str]:
        """Committed files that are not merged."""
        replaced = set((manifest or self.manifest())["replaced"])
        return [f for f in self.committed() if f.rsplit("/", 1)[1] not in replaced]

    def read(self) -> DataFrame:
        """Every archived row once: merged dates and the files since."""
        manifest = self.manifest()
        parts, files = self._merged(manifest["dates"]), self.open_files(manifest)
        if files or not parts:
            parts.append(self._files(files) if files else self.spark.read.parquet(self.path))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def compact(self, before: str | None = None, min_files: int = 2) -> dict | None:
        """Merge the dates below ``before`` (all where it is None) that have at least
        ``min_files`` open files; a date merged earlier is merged again with its
        late files. The manifest, or None where there was nothing to do."""
        manifest = self.manifest()
        by_date: dict[str, list[str]] = {}
        for f in self.open_files(manifest):
            by_date.setdefault(self._date_of(f), []).append(f)
        ripe = {d: fs for d, fs in by_date.items() if len(fs) >= min_files and d != "__HIVE_DEFAULT_PARTITION__"
                and (before is None or d < before)}
        if not ripe:
            return None
        rows = self._files([f for fs in ripe.values() for f in fs])
        for old in self._merged({d: v for d, v in manifest["dates"].items() if d in ripe}):
            rows = rows.unionByName(old, allowMissingColumns=True)
        taken = [int(p.rsplit("=", 1)[1]) for p in self.manifests.glob(f"{self.merged_path}/version=*")]
        version = max([manifest["version"], *self.manifests.versions(), *taken], default=0) + 1
        # small dates share a task, a large one is split: files of about the advisory size
        (rows.hint("rebalance", self.date_col).sortWithinPartitions(self.date_col, self.cluster_col)
         .write.mode("errorifexists").partitionBy(self.date_col).parquet(f"{self.merged_path}/version={version}"))
        doc = {"replaced": [*manifest["replaced"], *(f.rsplit("/", 1)[1] for fs in ripe.values() for f in fs)],
               "dates": {**manifest["dates"], **{d: version for d in ripe}}}
        self.manifests.commit(version, doc)
        return {**doc, "version": version}
