"""SimHash near-duplicates by the general pigeonhole principle.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of the
word shingles of a whole text. Texts of one fingerprint are one node. To link
fingerprints within ``distance`` bits, the 64 bits are grouped into parts, bits
that go together in one part; for every fingerprint the threshold of each part
(-1: not probed) is chosen by dynamic programming on estimated candidate
counts, with sum(threshold + 1) = distance + 1, so that two fingerprints within
the distance agree within the threshold on some part. All values within a
part's threshold are probed against the parts of all fingerprints, and every
candidate is verified on all 64 bits in the join itself.

Counts rest on all distinct fingerprints: bit co-occurrence and histograms of
groups of at most SUB_BITS bits (bounded tables) are summed up by Spark. No
fingerprint or link reaches the driver.

Defined results: a null or empty text has fingerprint 0, linked like any other;
a text of fewer words than a shingle has one shingle, all its words; repeated
rows share a fingerprint and so a component; an empty table gives an empty
result. Ids are integers. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventide.llm.blocks import col, keyed_texts, small_batches, utf8, word_parts
from eventide.llm.components import connected_components
from eventide.session import ensure_checkpoint_dir, shared_dir

BITS = 64
#: Bits of a histogram that estimates candidates, at most.
SUB_BITS = 11
#: Numbers of parts that are weighed against each other.
PART_COUNTS = (2, 3, 4)
#: Tasks over which the rows of one group of copies are dealt.
SALTS = 16
#: Cost of a probe row against that of a candidate that is verified.
PROBE_COST = 1.0
CANDIDATE_COST = 0.2


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a text in UTF-8."""
    tail: list[bytes] = []
    ones, total = np.zeros(BITS, np.int64), 0
    digest = xxhash.xxh64_intdigest
    for part in word_parts(text.lower()):  # of bytes: A to Z only
        words = tail + part.split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            length = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(length + 1) - 1
            first, last = (end - length)[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist()
            h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(first, last)), np.uint64, len(first))
            ones += _bits(h).sum(0, dtype=np.int64)
            total += len(h)
            tail = words[len(words) - shingle + 1:]
        else:
            tail = words
    if not total:
        return digest(b" ".join(tail), seed) if tail else 0
    return int(((ones * 2 > total).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


def _bits(h: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, h, fp)`` of every whole text: a hash of it and its fingerprint, a signed bigint."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in utf8(b["text"])], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["h"], pa.array(fp)], names=["doc_id", "h", "fp"])

    texts = keyed_texts(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("h"), "text")
    return texts.mapInArrow(run, "doc_id bigint, h bigint, fp bigint")


def _summed(table: DataFrame, keys: list[str], count: Callable[[np.ndarray], list[np.ndarray]], kinds: str) -> list:
    """Rows that each task makes of all its fingerprints, summed up by ``keys``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            part = count(b["fp"].to_numpy(zero_copy_only=False).view(np.uint64))
            total = part if total is None else [x + y for x, y in zip(total, part)]
        if total is not None:
            which = np.repeat(np.arange(len(total)), [len(t) for t in total])
            at = np.concatenate([np.arange(len(t)) for t in total])
            n = np.concatenate(total)
            some = n != 0
            yield pa.RecordBatch.from_arrays([pa.array(which[some]), pa.array(at[some]), pa.array(n[some])],
                                             names=["which", "at", "n"])

    return (table.select("fp").mapInArrow(run, f"which bigint, at bigint, n {kinds}")
            .groupBy(*keys).agg(F.sum("n").alias("n")).collect())


def correlated_parts(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of even size; each group starts at the free bit
    most correlated with the free ones and takes the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    phi = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(phi, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - k)
        group = [max(free, key=lambda b: phi[b, free].sum())]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: phi[b, group].sum()))
            free.remove(group[-1])
        out.append(group)
    return out


def gather_bits(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits as one number each, the first lowest."""
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


@dataclass
class Layout:
    """Parts of the bits, and for each its sub-groups with, for every value, how
    many fingerprints lie 0, 1, ... ``distance`` bits from it."""
    parts: list[list[int]]
    distance: int
    near: list[list[np.ndarray]]
    n: int

    @staticmethod
    def subs(part: list[int]) -> list[list[int]]:
        k = -(-len(part) // SUB_BITS)
        return [list(map(int, s)) for s in np.array_split(part, k)]

    @classmethod
    def of(cls, parts: list[list[int]], distance: int, histograms: list[list[np.ndarray]], n: int) -> Layout:
        near = []
        for part, hist in zip(parts, histograms):
            near.append([])
            for bits, h in zip(cls.subs(part), hist):
                value, rows = np.arange(1 << len(bits)), []
                for d in range(distance + 1):
                    rows.append(sum(h[value ^ sum(1 << b for b in flips)] for flips in combinations(range(len(bits)), d)))
                near[-1].append(np.array(rows, np.float64) / max(n, 1))
        return cls(parts, distance, near, n)

    def costs(self, fp: np.ndarray) -> np.ndarray:
        """Cost of each part (axis 0) at thresholds -1 .. distance (axis 1) for each fingerprint."""
        out = np.zeros((len(self.parts), self.distance + 2, len(fp)))
        for i, part in enumerate(self.parts):
            share = None  # of fingerprints at distance 0, 1, ... on this part, as if sub-groups were independent
            for bits, table in zip(self.subs(part), self.near[i]):
                t = table[:, gather_bits(fp, bits)]
                share = t if share is None else np.array(
                    [sum(share[a] * t[d - a] for a in range(d + 1)) for d in range(self.distance + 1)])
            probes = np.cumsum([len(list(combinations(range(len(part)), d))) for d in range(self.distance + 1)])
            out[i, 1:] = PROBE_COST * probes[:, None] + CANDIDATE_COST * self.n * np.cumsum(share, axis=0)
        return out

    def thresholds(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cheapest thresholds (parts x fingerprints), sum(t + 1) = distance + 1, and their cost."""
        cost, units = self.costs(fp), self.distance + 1
        best = np.full((units + 1, len(fp)), np.inf)
        best[0] = 0
        taken = []
        for i in range(len(self.parts)):
            options = np.full((units + 1, units + 1, len(fp)), np.inf)  # [units so far, units here]
            for s in range(units + 1):
                for e in range(s + 1):
                    options[s, e] = best[s - e] + cost[i, e]
            taken.append(options.argmin(1))
            best = options.min(1)
        left = np.full(len(fp), units)
        out = np.empty((len(self.parts), len(fp)), np.int64)
        for i in reversed(range(len(self.parts))):
            here = taken[i][left, np.arange(len(fp))]
            out[i] = here - 1
            left = left - here
        return out, best[units]


def plan(distinct: DataFrame, distance: int) -> Layout | None:
    """The layout of the least estimated cost over all ``distinct (fp)``."""
    def together(fp: np.ndarray) -> list[np.ndarray]:
        x = _bits(fp).astype(np.float64)
        return [(x.T @ x).astype(np.int64).ravel(), np.array([len(fp)])]

    pairs, n = np.zeros(BITS * BITS, np.int64), 0
    for r in _summed(distinct, ["which", "at"], together, "bigint"):
        if r["which"] == 0:
            pairs[r["at"]] = r["n"]
        else:
            n = r["n"]
    if not n:
        return None
    choices = [correlated_parts(pairs.reshape(BITS, BITS), n, m) for m in PART_COUNTS]
    flat = [s for parts in choices for part in parts for s in Layout.subs(part)]

    def histograms(fp: np.ndarray) -> list[np.ndarray]:
        return [np.bincount(gather_bits(fp, bits), minlength=1 << len(bits)) for bits in flat]

    tables = [np.zeros(1 << len(bits), np.int64) for bits in flat]
    for r in _summed(distinct, ["which", "at"], histograms, "bigint"):
        tables[r["which"]][r["at"]] = r["n"]
    rest = iter(tables)
    layouts = [Layout.of(parts, distance, [[next(rest) for _ in Layout.subs(part)] for part in parts], n)
               for parts in choices]

    def cost(fp: np.ndarray) -> list[np.ndarray]:
        return [np.array([sum(x.thresholds(fp[a:a + 20_000])[1].sum() for a in range(0, len(fp), 20_000))])
                for x in layouts]

    total = {r["which"]: r["n"] for r in _summed(distinct, ["which", "at"], cost, "double")}
    return layouts[min(total, key=lambda k: (round(total[k], 3), k))]


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: the ``rep`` of all pairs of ``distinct (fp, rep)`` whose
    fingerprints differ in 1 to ``distance`` bits; a pair may come repeatedly."""
    spark = distinct.sparkSession
    layout = plan(distinct, distance)
    if layout is None:
        return spark.createDataFrame([], "a bigint, b bigint")
    masks = [[np.array([sum(1 << b for b in flips) for flips in combinations(range(len(part)), d)], np.int64)
              for d in range(distance + 1)] for part in layout.parts]
    kind = "key bigint, fp bigint, rep bigint"

    def rows(key: list, fp: list, rep: list) -> pa.RecordBatch:
        put = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([put(key), put(fp), put(rep)], names=["key", "fp", "rep"])

    def columns(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fp, rep = (b[c].to_numpy(zero_copy_only=False) for c in ("fp", "rep"))
        for at in range(0, len(fp), 5_000):
            yield fp[at:at + 5_000], rep[at:at + 5_000]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fp, rep in columns(b):
                key = [gather_bits(fp.view(np.uint64), part) | i << 56 for i, part in enumerate(layout.parts)]
                yield rows(key, [fp] * len(key), [rep] * len(key))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fp, rep in columns(b):
                out: tuple[list, list, list] = [], [], []
                chosen, _ = layout.thresholds(fp.view(np.uint64))
                for i, part in enumerate(layout.parts):
                    value = gather_bits(fp.view(np.uint64), part) | i << 56
                    for d in range(distance + 1):
                        some, m = np.flatnonzero(chosen[i] >= d), masks[i][d]
                        if len(some) and len(m):
                            out[0].append((value[some][:, None] ^ m).ravel())
                            out[1].append(np.repeat(fp[some], len(m)))
                            out[2].append(np.repeat(rep[some], len(m)))
                yield rows(*out)

    table = distinct.select("fp", "rep")
    q = table.mapInArrow(probe, kind).toDF("key", "q_fp", "q_rep")
    x = table.mapInArrow(index, kind).toDF("key", "x_fp", "x_rep")
    near = (F.bit_count(F.col("q_fp").bitwiseXOR(F.col("x_fp"))) <= distance) & (F.col("q_fp") < F.col("x_fp"))
    return q.join(x, (q["key"] == x["key"]) & near).select(F.col("q_rep").alias("a"), F.col("x_rep").alias("b"))


def grouped(fps: DataFrame, distance: int) -> DataFrame:
    """``(fp, low, grp)`` of every distinct fingerprint: the smallest id that has it, and the
    smallest fingerprint (as a signed number) that can be reached over links. Fingerprints
    are the nodes, so an id that several texts bear joins none of them."""
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low")).checkpoint()
    found = connected_components(links(distinct.select("fp", F.col("fp").alias("rep")), distance))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("grp"))


def cluster(docs: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``: component_id is the smallest id that can be
    reached over links of at most ``distance`` bits; null where no row reached has one."""
    ensure_checkpoint_dir(docs.sparkSession)
    fps = fingerprints(docs, shingle, seed, id_col, text_col).checkpoint()
    groups = grouped(fps, distance).checkpoint()
    lowest = groups.groupBy("grp").agg(F.min("low").alias("component_id"))
    known = groups.join(lowest, "grp").select("fp", "component_id")
    return fps.join(known, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the one of the smallest id (none comes last),
    of texts under one id the one of the smallest hash. Rows are judged by id and
    text, so texts that share an id are judged apart, and rows without an id too."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    fps = fingerprints(docs, shingle, 42, id_col, text_col).checkpoint()
    rows = fps.groupBy("doc_id", "h", "fp").agg(F.count(F.lit(1)).alias("n"))
    placed = rows.join(grouped(fps, distance).select("fp", "grp"), "fp").checkpoint()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    # only groups of several rows have one to choose; each is dealt over SALTS tasks
    best = placed.groupBy("grp").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    dealt = best.select("grp", "best", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    judged = placed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS))).join(dealt, ["grp", "salt"], "left").select(
        "doc_id", "h", "n", (F.col("best").isNull() | order.eqNullSafe(F.col("best"))).alias("first"))
    # what goes, and what stands there more than once, as a table: the join with the
    # documents is planned on its real size, and moves no text where that is small
    path = shared_dir(spark, "near_duplicates")
    judged.filter("n > 1 or not first").write.parquet(path)
    out = spark.read.parquet(path).select(F.col("doc_id").alias("_id"), F.col("h").alias("_hash"), "first")
    texts = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d"), col(id_col).cast("bigint").alias("_key"),
                        F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit(""))).alias("_h"))
    same = (F.col("_h") == F.col("_hash")) & F.col("_key").eqNullSafe(F.col("_id"))
    once = texts.join(out, same, "left_anti")
    again = texts.join(out.filter("first"), same, "left_semi").dropDuplicates(["_key", "_h"])
    return once.union(again).select("d.*")
