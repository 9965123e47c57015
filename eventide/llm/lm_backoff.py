"""Language-model scores from a weighted backoff automaton.

Model: n-grams of the training documents, smoothed by a Dirichlet prior,
``p(w | h) = (c(hw) + K p(w | h')) / (c(h) + K)``, h' the history without its first
word, down to ``p(w) = (c(w) + 1) / (N + V + 1)``, which keeps one share for a word
never seen. As an automaton every seen history is a state, every seen n-gram an
arc with its probability, and a missing arc is replaced by the failure arc to the
state of h', with weight ``K / (c(h) + K)``. A text is read from left to right
once: the state is carried, failure arcs are followed until the word has an arc,
and the log-probabilities add up.

The counts grow with the corpus, so no task or driver ever holds the model. Texts
are packed into blocks of some MB (a long text into parts that carry their last
words over). A block emits each n-gram it holds once, as sorted 64-bit hashes cut
into ranges, with its training count; a group for each range adds up the counts
of all blocks and answers each block in the order it asked, so an answer is
counts only. With the answers a block builds the automaton of the n-grams its
texts can meet, which leaves out nothing a traversal could reach, and reads its
texts. A frequent n-gram is one entry of each block, never a row of each place.
The number of ranges follows the size of the corpus.

N and V count distinct words by their 64-bit hashes: two words share one with a
chance of 3 in 10^8 for a million distinct words. A null text is empty, an empty text has the end token
alone, a null id draws its fold from the empty string; repeated rows are
documents of their own, an empty table gives no rows. Columns other than id and
text are ignored. Without training documents every probability is 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import keyed_texts, small_batches, utf8, word_parts
from eventide.session import ensure_checkpoint_dir

#: Bytes of text of a block, of a part of a text, and of the corpus for each range of hashes.
BLOCK_BYTES, PART_BYTES, RANGE_BYTES = 4 << 20, 1 << 20, 16 << 20
#: Order of the model and strength of the prior.
ORDER, STRENGTH = 2, 100.0
#: Tokens that stand for the start and end of a text; no word holds white space.
START, END = b"\r", b"\n"

SQL = rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text,
             xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                 lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0],
                     lambda b, _: xor(b >> 1, (b & 1) * 3988292384))), 4294967295) % 7 = 2 AS held_out FROM documents),
w AS (SELECT doc_id, held_out, list_concat(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [chr(10)]) AS ws FROM d),
t AS (SELECT doc_id, held_out, unnest(ws) AS word, unnest(list_concat([chr(13)], ws[1:len(ws) - 1])) AS prev FROM w),
c1 AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY word),
c2 AS (SELECT prev, word, count(*) AS c FROM t WHERE NOT held_out GROUP BY prev, word),
h AS (SELECT prev, sum(c) AS c FROM c2 GROUP BY prev),
z AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c1),
s AS (SELECT doc_id, held_out, n, c1.c AS known, (coalesce(c1.c, 0) + 1) / (n + v + 1) AS p,
             coalesce(c2.c, 0) AS c, coalesce(h.c, 0) AS ch
      FROM t CROSS JOIN z LEFT JOIN c1 USING (word) LEFT JOIN c2 USING (prev, word) LEFT JOIN h USING (prev))
SELECT doc_id, held_out, count(*) AS n_tokens, count(known) AS n_known, CAST(n AS BIGINT) AS train_tokens,
       round(fsum(log10(p)), 6) AS base_score, round(fsum(log10((c + {STRENGTH} * p) / (ch + {STRENGTH}))), 6) AS score
FROM s GROUP BY doc_id, held_out, n"""


def held_out() -> Column:
    """The documents the model does not learn from."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 7 == 2


# --- blocks of texts ----------------------------------------------------------------

def packed(docs: DataFrame, order: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(block, row, doc_id, learn, context, last, length, size, texts)``, one row for a block:
    lists over its parts and the compressed texts. Checkpointed, so that both
    readers see the same blocks whatever is lost in between."""
    small_batches(docs.sparkSession)
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed_texts(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                                      (~held_out()).alias("learn"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            columns = (batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["learn"].to_pylist(), utf8(batch["text"]))
            for row, doc_id, learn, text in zip(*columns):
                context = START  # the words that stand before a part
                held = None
                for part in word_parts(text.lower(), PART_BYTES):
                    if held is not None:
                        parts.append((row, doc_id, learn, context, False, held))
                        # single spaces keep the start token, which split() would drop
                        context = b" ".join((context.split(b" ") + held.split())[-(order - 1):]) if order > 1 else b""
                    held = part
                    size += len(part) + 64
                    if size >= BLOCK_BYTES:
                        if parts:
                            yield _block(number, parts, kind)
                            number, parts = number + 1, []
                        size = len(part)
                parts.append((row, doc_id, learn, context, True, held))
        if parts:
            yield _block(number, parts, kind)

    schema = (f"block long, row array<long>, doc_id array<{id_type}>, learn array<boolean>, context array<binary>, "
              "last array<boolean>, length array<int>, size long, texts binary")
    return rows.mapInArrow(pack, schema).checkpoint()


def _block(number: int, parts: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    row, doc_id, learn, context, last, texts = zip(*parts)
    whole = b"".join(texts)
    types = (pa.int64(), kind, pa.bool_(), pa.binary(), pa.bool_(), pa.int32())
    lists = [pa.array([v], pa.list_(t)) for v, t in zip((row, doc_id, learn, context, last, [len(t) for t in texts]), types)]
    columns = [pa.array([number], pa.int64()), *lists, pa.array([len(whole)], pa.int64()),
               pa.array([pa.compress(whole, "zstd", asbytes=True)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "row", "doc_id", "learn", "context", "last", "length", "size", "texts"])


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Grams:
    """The n-grams of a block: for each order the sorted distinct hashes, their training
    counts in this block, a place of each, and for each place its number (-1: none)."""

    def __init__(self, block: dict, order: int):
        whole, at = pa.decompress(block["texts"], block["size"], "zstd", asbytes=True), 0
        words, spans, predict, learn = [], [], [], []
        for context, last, length, learns in zip(block["context"], block["last"], block["length"], block["learn"]):
            before = context.split(b" ") if context else []
            own = whole[at:at + length].split() + ([END] if last else [])
            at += length
            spans.append((len(words) + len(before), len(words) + len(before) + len(own), len(words)))
            words += before
            words += own
            predict.append((len(before), len(own), learns))
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        vocabulary = coded.dictionary.to_pylist()
        self.spans, self.n_words = spans, len(vocabulary)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in vocabulary] or [0], np.uint64)
        one = hashes[self.ids] if len(self.ids) else np.zeros(0, np.uint64)
        own = np.repeat(np.tile([False, True], len(predict)), np.array([(b, o) for b, o, _ in predict], np.int64).ravel())
        weight = own & np.repeat([l for *_, l in predict], [b + o for b, o, _ in predict]).astype(bool)
        place = np.arange(len(one)) - np.repeat([s for *_, s in spans], [b + o for b, o, _ in predict]) if len(one) else np.zeros(0, np.int64)
        self.is_start = (one == np.uint64(xxhash.xxh3_64_intdigest(START)))
        end = np.uint64(xxhash.xxh3_64_intdigest(END))
        self.distinct, self.counts, self.first, self.number = [], [], [], []
        h = one
        for k in range(1, order + 1):
            if k > 1:
                before = np.concatenate((h[:1], h[:-1]))
                h = _mix(before, one)
            valid = np.flatnonzero((place >= k - 1) & ~self.is_start)
            keys = h[valid] if k > 1 else np.append(h[valid], end)  # the end token is asked for in any case
            distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            weights = weight[valid] if k > 1 else np.append(weight[valid], False)
            self.counts.append(np.bincount(inverse, weights, len(distinct)).astype(np.int64))
            if k == 1:
                self.end = int(inverse[-1])
                inverse, valid_at = inverse[:-1], np.append(valid, -1)
            else:
                valid_at = valid
            number = np.full(len(one), -1, np.int64)
            number[valid] = inverse
            self.distinct.append(distinct), self.first.append(valid_at[first]), self.number.append(number)


def _squeeze(values: np.ndarray) -> bytes:
    """Compressed planes of bytes of unsigned integers."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), "zstd", asbytes=True)


def _expand(data: bytes, n: int, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _cuts(distinct: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted hashes."""
    step = (1 << 64) // ranges + 1
    return np.searchsorted(distinct, np.array([min(r * step, (1 << 64) - 1) for r in range(ranges)], np.uint64))


# --- counting ---------------------------------------------------------------------------

ASKED = "gram int, range int, block long, n int, hashes binary, counts binary"
ANSWER = "gram int, range int, block long, n int, counts binary, tokens long, words long"
BLOCK_COLUMNS = ("texts", "size", "context", "last", "length", "learn")


def counted(blocks: DataFrame, order: int, ranges: int) -> DataFrame:
    """``ANSWER`` rows: for each block, order and range the corpus counts of its n-grams; for each
    range of single words one row of block -1 with its training tokens and distinct words."""
    def ask(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block = {c: batch[c][row].as_py() for c in ("block", *BLOCK_COLUMNS)}
                yield from _asked(block, order, ranges)

    def add(table: pa.Table) -> pa.Table:
        gram, part = table["gram"][0].as_py(), table["range"][0].as_py()
        sizes = table["n"].to_pylist()
        hashes = np.concatenate([np.cumsum(_expand(h.as_py(), n, "<u8"), dtype=np.uint64) for h, n in zip(table["hashes"], sizes)])
        counts = np.concatenate([_expand(c.as_py(), n, "<u4") for c, n in zip(table["counts"], sizes)])
        distinct, inverse = np.unique(hashes, return_inverse=True)
        total = np.bincount(inverse, counts, len(distinct)).astype("<u8")
        edges = np.cumsum([0, *sizes])
        answers = [_squeeze(total[inverse[a:b]]) for a, b in zip(edges, edges[1:])]
        rows = [(gram, part, b, n, a, None, None) for b, n, a in zip(table["block"].to_pylist(), sizes, answers)]
        if gram == 1:
            rows.append((gram, part, -1, 0, None, int(total.sum()), int(np.count_nonzero(total))))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        names = ("gram", "range", "block", "n", "counts", "tokens", "words")
        return pa.table({name: pa.array(c, t) for name, c, t in zip(names, zip(*rows), types)})

    asked = blocks.select("block", *BLOCK_COLUMNS).mapInArrow(ask, ASKED)
    return asked.groupBy("gram", "range").applyInArrow(add, ANSWER)


def _asked(block: dict, order: int, ranges: int) -> Iterator[pa.RecordBatch]:
    grams = Grams(block, order)
    for k in range(order):
        distinct, counts = grams.distinct[k], grams.counts[k].astype("<u4")
        starts = _cuts(distinct, ranges)
        ends = np.append(starts[1:], len(distinct))
        full = np.flatnonzero(ends > starts)
        hashes = [_squeeze(np.diff(distinct[starts[r]:ends[r]], prepend=np.uint64(0)).astype("<u8")) for r in full]
        columns = [pa.array(np.full(len(full), k + 1), pa.int32()), pa.array(full, pa.int32()),
                   pa.array(np.full(len(full), block["block"]), pa.int64()), pa.array((ends - starts)[full], pa.int32()),
                   pa.array(hashes, pa.binary()), pa.array([_squeeze(counts[starts[r]:ends[r]]) for r in full], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["gram", "range", "block", "n", "hashes", "counts"])


# --- automaton ---------------------------------------------------------------------------

class Automaton:
    """States, arcs and failure arcs of the n-grams of one block. State 0 has no history; the
    state of a k-gram has arcs by the words that follow it, which are (k+1)-grams. A word's
    arc from the state before it is looked up for all places of the block at once, by
    the n-gram that ends there, instead of in a table of (state, word)."""

    def __init__(self, grams: Grams, totals: list[np.ndarray], tokens: int, words: int, strength: float):
        order, n_start = len(totals), len(totals[0])
        norm = float(tokens + words + 1)
        # the start of a text is a history as often as there are training texts, that is, ends
        totals = [np.append(totals[0], totals[0][grams.end]), *totals[1:]]
        self.numbers = [np.where(grams.is_start, n_start, grams.number[0]), *grams.number[1:]]
        seen = [t > 0 for t in totals]
        self.state, n_states = [], 1
        for k in range(order - 1):
            state = np.zeros(len(totals[k]), np.int64)
            state[seen[k]] = np.arange(n_states, n_states + seen[k].sum())
            n_states += int(seen[k].sum())
            self.state.append(state)
        fail, weight, level = np.zeros(n_states, np.int64), np.zeros(n_states), np.zeros(n_states, np.int64)
        for k in range(order - 1):
            own = self.state[k][seen[k]]
            weight[own], level[own] = np.log10(strength / (totals[k][seen[k]] + strength)), k + 1
        p = [(totals[0] + 1) / norm]
        targets = [self.state[0] if order > 1 else np.zeros(n_start + 1, np.int64)]
        for k in range(1, order):
            at = grams.first[k]
            suffix, history = self.numbers[k - 1][at], self.numbers[k - 1][at - 1]
            p.append((totals[k] + strength * p[k - 1][suffix]) / (totals[k - 1][history] + strength))
            if k < order - 1:
                fail[self.state[k][seen[k]]] = self.state[k - 1][suffix[seen[k]]]
                targets.append(self.state[k])
            else:
                targets.append(self.state[k - 1][suffix])
        # arcs of all orders in one numbering; a word has an arc from the root in any case
        offsets = np.cumsum([0, *map(len, p[:-1])])
        there = [n >= 0 if k == 0 else np.append(seen[k], False)[n] for k, n in enumerate(self.numbers)]
        self.arcs = [np.where(t, n + o, -1).tolist() for t, n, o in zip(there, self.numbers, offsets)]
        self.log_p, self.target = np.log10(np.concatenate(p)).tolist(), np.concatenate(targets).tolist()
        self.fail, self.weight, self.level = fail.tolist(), weight.tolist(), level.tolist()
        self.base, self.known = np.log10(p[0])[self.numbers[0]], seen[0][self.numbers[0]]

    def state_at(self, place: int, first: int) -> int:
        """The state of the longest seen history that ends at ``place`` and begins at ``first`` or later."""
        for k in range(min(len(self.state), place - first + 1), 0, -1):
            entry = self.numbers[k - 1][place]
            if entry >= 0 and self.state[k - 1][entry]:
                return int(self.state[k - 1][entry])
        return 0

    def read(self, start: int, end: int, state: int) -> float:
        """The log10 probability of the words at these places, read from left to right."""
        arcs, fail, weight, level, log_p, target = self.arcs, self.fail, self.weight, self.level, self.log_p, self.target
        logs = []
        for place in range(start, end):
            arc = arcs[level[state]][place]
            while arc < 0:  # no arc by this word: on to the shorter history
                logs.append(weight[state])
                state = fail[state]
                arc = arcs[level[state]][place]
            logs.append(log_p[arc])
            state = target[arc]
        return math.fsum(logs)


def score(docs: DataFrame, order: int = ORDER, strength: float = STRENGTH, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every document."""
    blocks = packed(docs, order, id_col, text_col)
    size = blocks.agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, math.ceil((size["s"] or 0) / RANGE_BYTES))
    answers = counted(blocks, order, ranges).checkpoint()
    facts = answers.filter("block = -1").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    tokens, words = int(facts["n"] or 0), int(facts["v"] or 0)
    id_type = blocks.schema["doc_id"].dataType.elementType.simpleString()

    def traverse(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("gram", "ascending"), ("range", "ascending")])
        block = {c: left[c][0].as_py() for c in BLOCK_COLUMNS}
        grams = Grams(block, order)
        totals = [[np.zeros(0, "<u8")] for _ in range(order)]
        for gram, n, counts in zip(right["gram"].to_pylist(), right["n"].to_pylist(), right["counts"].to_pylist()):
            totals[gram - 1].append(_expand(counts, n, "<u8"))
        totals = [np.concatenate(t).astype(np.int64) for t in totals]
        automaton = Automaton(grams, totals, tokens, words, strength)
        out = []
        for start, end, first in grams.spans:
            state = automaton.state_at(start - 1, first) if start > first else 0
            out.append((end - start, int(automaton.known[start:end].sum()), math.fsum(automaton.base[start:end].tolist()),
                        automaton.read(start, end, state)))
        n_tokens, n_known, base, total = zip(*out)
        kind = left.schema.field("doc_id").type.value_type
        return pa.table({"row": pa.array(left["row"][0].as_py(), pa.int64()), "doc_id": pa.array(left["doc_id"][0].as_py(), kind),
                         "learn": pa.array(block["learn"], pa.bool_()), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()),
                         "score": pa.array(total, pa.float64())})

    schema = f"row long, doc_id {id_type}, learn boolean, n_tokens long, n_known long, base_score double, score double"
    parts = blocks.groupBy("block").cogroup(answers.filter("block >= 0").groupBy("block")).applyInArrow(traverse, schema)
    # a long text has several parts
    return (parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("learn").alias("learn"),
                                     *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
            .select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
                    F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"))
