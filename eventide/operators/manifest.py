"""Numbered manifests: small JSON files that say what a table consists of.

A writer first writes its data under a new version folder and then creates the
manifest of that number; creation fails where the number is taken, so of two
writers one wins and the other's data are never referred to. Readers take the
greatest manifest that parses; data once referred to are not changed, so a
reader keeps a consistent view while a newer version is written.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class ManifestLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def glob(self, pattern: str) -> list[str]:
        """Paths that match a pattern of the cluster's file system, one listing."""
        found = self._fs.globStatus(self._path(pattern))
        return [str(f.getPath().toString()) for f in found or []]

    def versions(self) -> list[int]:
        names = (p.rsplit("/", 1)[1] for p in self.glob(f"{self.folder}/*.json"))
        return sorted(int(n[:-5]) for n in names if n[:-5].isdigit())

    def read(self, version: int) -> dict | None:
        """The manifest of a version; None where its writer broke off."""
        stream = self._fs.open(self._path(f"{self.folder}/{version}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def latest(self) -> dict | None:
        for version in reversed(self.versions()):
            doc = self.read(version)
            if doc is not None:
                return doc
        return None

    def commit(self, version: int, doc: dict) -> None:
        """Create the manifest; an error where the version is taken."""
        stream = self._fs.create(self._path(f"{self.folder}/{version}.json"), False)
        stream.write(bytearray(json.dumps({**doc, "version": version}), "utf-8"))
        stream.close()


def ranges(ids) -> list[list[int]]:
    """Whole numbers as closed ranges."""
    out: list[list[int]] = []
    for i in sorted(set(ids)):
        if out and i == out[-1][1] + 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return out


def within(spans: list[list[int]], i: int) -> bool:
    return any(a <= i <= b for a, b in spans)
