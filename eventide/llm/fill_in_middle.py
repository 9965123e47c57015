"""Fill-in-middle transformation by secondary sort.

A text is cut into units (a word with the white space before it, or the white
space at the end). Two draws from a hash of the id cut it into prefix, middle
and suffix; the output has them in another order behind sentinels. Texts are
not put together in a row: every one is emitted as *pieces* of some hundred
units, keyed by document and output position. One exchange by document and a
sort within partitions (``repartition`` and ``sortWithinPartitions``) bring the
pieces into output order, a stream over the sorted rows feeds them to a digest,
piece by piece. The restoring side reads that output stream alone: it finds the
sentinels, gives each run of bytes its place in the original, and a second sort
within the same partitions streams them into the digest of the restored text.
No task holds more than one piece of a text beside Spark's sort buffers, which
spill.

A plain text is its own output and takes the same way: its pieces are exchanged,
sorted, digested and restored like any other's.

Rows: a null text is empty, an empty text plain; a null id draws from the hash
of ``42:`` alone. Repeated rows are documents of their own: rows are told apart
by their place in the input, so give a table or a checkpointed frame. Columns
other than id and text are ignored. Long texts take more pieces, nothing else;
a unit of more than ``CHUNK_BYTES`` is emitted in several pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType

from eventide.llm.blocks import SPACE, col, keyed_texts, small_batches, utf8, word_spans

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The order of the sentinels in an output, by form.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: The place of each part in the original.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
#: Units and bytes of a piece at most.
CHUNK_UNITS, CHUNK_BYTES = 512, 1 << 16
#: Restored positions: part number in the upper bits, number of the piece below.
SHIFT = 40

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACE)] = False

SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                  THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM c),
p AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
             array_to_string(units[b + 1:], '') AS s FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""

_FACTS = "n long, form string, prefix_chars long, middle_chars long"


def _id_type(df: DataFrame) -> DataType:
    return df.schema["doc_id"].dataType


def _offsets(text: bytes) -> np.ndarray:
    """Byte offset behind each unit, with 0 first."""
    _, ends = word_spans(np.frombuffer(text, np.uint8), _IS_WORD)
    tail = [len(text)] if text and (not len(ends) or ends[-1] < len(text)) else []
    return np.concatenate(([0], ends, tail)).astype(np.int64)


def _chars(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _chunks(text: bytes, offsets: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """Units ``first`` to ``last`` of a text in pieces."""
    for k in range(first, last, CHUNK_UNITS):
        start, end = int(offsets[k]), int(offsets[min(k + CHUNK_UNITS, last)])
        for at in range(start, end, CHUNK_BYTES):
            yield text[at:min(at + CHUNK_BYTES, end)]


def _form(text: bytes, h3: int, h4: int, rate: int, spm: int) -> str:
    if not text or h3 % 100 >= rate or any(s in text for s in PLACE):
        return "plain"
    return "spm" if h4 % 100 < spm else "psm"


def pieces(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, n, form, prefix_chars, middle_chars, pos, chunk)``: each
    document's output as pieces in no order. The facts stand on the piece of position 0.

    ``rate``: percent of texts that are transformed; ``spm``: percent of those in
    suffix-first form."""
    small_batches(docs.sparkSession)
    # the draws come from the id as text, whatever columns the table has beside it
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digits = F.sha2(F.encode(name, "UTF-8"), 256)
    draws = [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = keyed_texts(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", *draws, "text")
    schema = f"row long, doc_id {_id_type(rows).simpleString()}, {_FACTS}, pos long, chunk binary"

    def cut(batches):
        for batch in batches:
            yield from _cut_batch(batch, rate, spm)

    return rows.mapInArrow(cut, schema)


def _cut_batch(batch: pa.RecordBatch, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    texts = utf8(batch["text"])
    draws = [batch[f"h{k}"].to_pylist() for k in (1, 2, 3, 4)]
    origin, facts, pos, chunk, size = [], [], [], [], 0

    def flush():
        at = pa.array(origin, pa.int64())
        ns, forms, prefixes, middles = zip(*facts)
        return pa.RecordBatch.from_arrays(
            [batch["row"].take(at), batch["doc_id"].take(at), pa.array(ns, pa.int64()), pa.array(forms, pa.string()),
             pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(pos, pa.int64()),
             pa.array(chunk, pa.binary())],
            ["row", "doc_id", "n", "form", "prefix_chars", "middle_chars", "pos", "chunk"])

    for k, (text, h1, h2, h3, h4) in enumerate(zip(texts, *draws)):
        offsets = _offsets(text)
        n = len(offsets) - 1
        form = _form(text, h3, h4, rate, spm)
        if form == "plain":
            fact = (n, form, None, None)
            out = _chunks(text, offsets, 0, n)
        else:
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            fact = (n, form, _chars(text[:offsets[a]]), _chars(text[offsets[a]:offsets[b]]))
            parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
            out = (c for s in ORDERS[form] for c in (s, *_chunks(text, offsets, *parts[s])))
        number = 0
        for c in out:
            origin.append(k), pos.append(number), chunk.append(c)
            facts.append(fact if number == 0 else (None,) * 4)
            number, size = number + 1, size + len(c)
            if size > 1 << 23:
                yield flush()
                origin, facts, pos, chunk, size = [], [], [], [], 0
        if number == 0:
            origin.append(k), pos.append(0), chunk.append(b""), facts.append(fact)
    if origin:
        yield flush()


def in_order(found: DataFrame) -> DataFrame:
    """The pieces of each document together and in output order: the one exchange."""
    return found.repartition("row").sortWithinPartitions("row", "pos")


class _Splitter:
    """Reads an output piece by piece and tells which part of the original each run
    of bytes belongs to. Two bytes are held back, as a sentinel may lie across pieces."""

    def __init__(self, form: str):
        self.left, self.part, self.held, self.number = list(ORDERS.get(form, ())), 0, b"", 0

    def _run(self, run: bytes) -> Iterator[tuple[int, bytes]]:
        if run:
            yield (self.part << SHIFT) + self.number, run
            self.number += 1

    def feed(self, chunk: bytes) -> Iterator[tuple[int, bytes]]:
        data, self.held = self.held + chunk, b""
        while self.left and (at := data.find(self.left[0])) >= 0:
            yield from self._run(data[:at])
            self.part = PLACE[self.left[0]]
            data = data[at + len(self.left.pop(0)):]
        if self.left:
            data, self.held = data[:-2], data[-2:]
        yield from self._run(data)

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.left:
            raise ValueError("an output without its sentinels")
        yield from self._run(self.held)


def outputs(ordered: DataFrame) -> DataFrame:
    """``(row, doc_id, facts, output_sha256, pos, chunk)`` from pieces in order: a row at
    position -1 with each document's facts and digest, and the pieces of its restored text."""
    id_type = _id_type(ordered).simpleString()

    def stream(batches):
        row, fact, sha, splitter = None, None, None, None
        out = _Rows()
        for batch in batches:
            heads = [batch[c].to_pylist() for c in ("row", "doc_id", "n", "form", "prefix_chars", "middle_chars")]
            for r, doc_id, n, form, prefix, middle, chunk in zip(*heads, batch["chunk"].to_pylist()):
                if r != row:
                    if row is not None:
                        out.close(row, fact, sha, splitter)
                    row, fact, sha, splitter = r, (doc_id, n, form, prefix, middle), hashlib.sha256(), _Splitter(form)
                sha.update(chunk)
                for place in splitter.feed(chunk):
                    out.piece(row, *place)
            if out.size > 1 << 22:
                yield out.batch(batch.schema.field("doc_id").type)
        if row is not None:
            out.close(row, fact, sha, splitter)
            yield out.batch(batch.schema.field("doc_id").type)

    return ordered.mapInArrow(stream, f"row long, doc_id {id_type}, {_FACTS}, output_sha256 string, pos long, "
                                      "chunk binary")


class _Rows:
    """Rows of ``outputs`` gathered for an Arrow batch."""

    NAMES = ("row", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "pos", "chunk")

    def __init__(self):
        self.rows, self.size = [], 0

    def piece(self, row, pos, chunk):
        self.rows.append((row, None, None, None, None, None, None, pos, chunk))
        self.size += len(chunk) + 100

    def close(self, row, fact, sha, splitter):
        for place in splitter.end():
            self.piece(row, *place)
        self.rows.append((row, *fact, sha.hexdigest(), -1, None))
        self.size += 200

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        types = (pa.int64(), id_type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        columns = list(zip(*self.rows)) or [()] * len(types)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(self.NAMES))


def digests(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` of every
    document, the last of the text rebuilt from the output and its form."""
    told = outputs(in_order(pieces(docs, **options)))
    id_type = _id_type(told).simpleString()

    def stream(batches):
        row, fact, sha, done, at = None, None, None, [], None
        for batch in batches:
            at = batch.schema.field("doc_id").type
            names = ("row", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "chunk")
            for r, *head, chunk in zip(*[batch[c].to_pylist() for c in names]):
                if r != row:
                    if row is not None:
                        done.append((*fact, sha.hexdigest()))
                    # position -1 comes first
                    row, fact, sha = r, tuple(head), hashlib.sha256()
                else:
                    sha.update(chunk)
            if len(done) >= 1000:
                yield _digest_batch(done, at)
                done = []
        if row is not None:
            done.append((*fact, sha.hexdigest()))
            yield _digest_batch(done, at)

    # the same partitions hold the same documents: this sort needs no exchange
    return told.sortWithinPartitions("row", "pos").mapInArrow(
        stream, f"doc_id {id_type}, {_FACTS}, output_sha256 string, restored_sha256 string")


def _digest_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = (id_type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(names))


def transform(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``: the output texts
    themselves, put together from the sorted pieces; a row holds one document."""
    ordered = in_order(pieces(docs, **options))
    id_type = _id_type(ordered).simpleString()

    def join(batches):
        row, fact, parts = None, None, []
        names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")

        def done(at):
            values = (*fact, b"".join(parts).decode("utf-8"))
            types = (at, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], list(names))

        for batch in batches:
            at = batch.schema.field("doc_id").type
            columns = [batch[c].to_pylist() for c in ("row", *names[:-1], "chunk")]
            for r, *head, chunk in zip(*columns):
                if r != row:
                    if row is not None:
                        yield done(at)
                    row, fact, parts = r, tuple(head), []
                parts.append(chunk)
        if row is not None:
            yield done(at)

    return ordered.mapInArrow(join, f"doc_id {id_type}, {_FACTS}, output string")


def restore(made: DataFrame, id_col: str = "doc_id", form_col: str = "form", output_col: str = "output") -> DataFrame:
    """``(doc_id, text)`` from outputs and their forms, by string functions: each
    output has its sentinels once and in the order of its form."""
    out, form = col(output_col), col(form_col)

    def between(a: str, b: str):
        return F.substring_index(F.substring_index(out, a, -1), b, 1)

    psm = F.concat(between("<P>", "<S>"), F.substring_index(out, "<M>", -1), between("<S>", "<M>"))
    spm = F.concat(between("<P>", "<M>"), F.substring_index(out, "<M>", -1), between("<S>", "<P>"))
    return made.select(col(id_col).alias("doc_id"),
                       F.when(form == "psm", psm).when(form == "spm", spm).otherwise(out).alias("text"))
