"""Shared helpers of the text operators: columns, samples and byte blocks.

Texts reach Python in Arrow batches. Everything that holds a value per byte or
per word works on *blocks*: buffers of about ``limit`` bytes that hold pieces
of texts, so memory does not grow with the length of a text or of a batch.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.session import ensure_checkpoint_dir

#: The folder that holds the package.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows an Arrow batch may hold. Texts of a few kB make batches of a few MB.
BATCH_ROWS = 500
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Bytes of the texts of a labelled sample, at most.
SAMPLE_BYTES = 256 << 20

#: Bytes that separate words (space and the ASCII controls from tab to return).
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same as a regular expression of words.
WORD = r"[^\x20\x09-\x0D]+"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def col(name: str) -> Column:
    """A top-level column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts fits a worker,
    and let Python workers find this package where the driver found it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])
    if not 0 < int(spark.conf.get(BATCH_CONF, "10000")) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` only, a null text as the empty one."""
    return docs.select(col(id_col).alias("doc_id"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int,
                    learn: Column | None = None, id_col: str = "doc_id",
                    text_col: str = "text", max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``(doc_id, text, label)``: at most ``bound`` rows and ``max_bytes`` of text, one for
    each of the first labelled ids by a hash of the id. Labels other than 0 and 1
    do not count; of repeated labels the smallest holds, of several texts of an id the one
    of the smallest hash; texts of over a sixteenth of ``max_bytes`` are left out. Ids are
    whole numbers, others stand as hashes. The ids are broadcast: ``bound`` limits them."""
    picked = (labels.select(col(id_col).alias("doc_id"), col(label).cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()))
    if learn is not None:
        picked = picked.filter(learn)
    picked = (picked.groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    ensure_checkpoint_dir(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).filter(F.octet_length("text") <= max_bytes // 16)
    rows = (texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")).checkpoint())
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    # one number for each of at most ``bound`` rows
    kept = (rows.select("doc_id", F.octet_length("text").cast("bigint").alias("size")).withColumn("upto", F.sum("size").over(upto))
            .filter(F.col("upto") <= max_bytes).select("doc_id"))
    number = F.col("doc_id").cast("string").try_cast("bigint")
    return rows.join(F.broadcast(kept), "doc_id").select(
        F.coalesce(number, F.xxhash64("doc_id")).alias("doc_id"), "text", "label")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """``text`` in parts of at most ``limit`` bytes, cut behind the end of a sentence
    or line, else behind white space, else where it stands."""
    at = 0
    while len(text) - at > limit:
        window = text[at:at + limit]
        cut = max(map(window.rfind, (b"\n", b".", b"!", b"?"))) + 1 or max(window.rfind(b" "), window.rfind(b"\t")) + 1 or limit
        yield text[at:at + cut]
        at += cut
    yield text[at:]


def blocks(texts: Iterable[bytes], limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about ``limit`` bytes: ``(bytes, starts, rows)``, where piece k
    begins at ``starts[k]``, belongs to text ``rows[k]`` and ends in a line feed."""
    parts, starts, rows, size = [], [], [], 0
    for row, text in enumerate(texts):
        for part in pieces(text, limit):
            parts.append(part)
            starts.append(size)
            rows.append(row)
            size += len(part) + 1
            if size >= limit:
                yield _buffer(parts, starts, rows)
                parts, starts, rows, size = [], [], [], 0
    if parts:
        yield _buffer(parts, starts, rows)


def _buffer(parts: list[bytes], starts: list[int], rows: list[int]):
    whole = b"\n".join(parts) + b"\n"
    return np.frombuffer(whole, np.uint8), np.array(starts, np.int64), np.array(rows, np.int64)


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that ``is_word`` (256 flags) marks."""
    inside = is_word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.concatenate((edge, [len(inside)]))
    return edge[::2], edge[1::2]


def head_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """64-bit hashes of the first bytes of each span, one for each (rising) width."""
    padded = np.concatenate((data, np.zeros(widths[-1], np.uint8)))
    h, out = np.full(len(starts), 0x9E3779B97F4A7C15, np.uint64), []
    for j in range(widths[-1]):
        byte = padded[starts + j].astype(np.uint64) + np.uint64(1)
        byte[lengths <= j] = 0
        h = (h ^ byte) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
        if j + 1 in widths:
            out.append(h)
    return out


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of whole spans, of any length: each byte times a power of an odd number."""
    length = end - begin
    if not len(length):
        return np.zeros(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    power = np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64)
    power = np.cumprod(power, dtype=np.uint64)
    h = np.add.reduceat((data[np.repeat(begin, length) + place].astype(np.uint64) + np.uint64(1)) * power[place], first)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_parts(text: bytes, limit: int = 1 << 20) -> Iterator[bytes]:
    """``text`` in parts of about ``limit`` bytes, cut at white space only."""
    at = 0
    while len(text) - at > limit:
        found = _BLANK.search(text, at + limit)
        if not found:
            break
        yield text[at:found.start()]
        at = found.end()
    yield text[at:] if at else text
