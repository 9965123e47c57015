"""Toxicity: multiple-instance learning over sentences, combined by noisy-or.

A sentence is scored by hashed words and word beginnings; a document is toxic
unless every sentence is innocent: p = 1 - prod(1 - p_s). Only document labels
train the sentence weights (Adagrad in numpy, on a bounded sample); all
sentences of all whole texts are scored on the executors, and those above
``threshold`` are located (code points, end exclusive). With
p_s = 1 - exp(-softplus(z_s)) the document needs one running sum, so a text of
any length is scored whole, block by block.

Defined results: a null or empty text has no sentence and score 0; repeated
rows get equal scores; an empty table gives an empty result; without labels of
both kinds every score is 0. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import (blocks, head_hashes, keyed_texts, labelled_sample, small_batches, utf8,
                                 word_spans)

#: Weights, a power of two.
BUCKETS = 1 << 18
#: Bytes of a word's beginnings that count as features beside the word itself.
HEADS = (4, 5, 6, 7)
#: Labelled rows the weights are fitted on, at most.
LEARN_ROWS = 10_000

IS_LETTER = np.zeros(256, bool)
IS_LETTER[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n")] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)) % np.uint64(BUCKETS - 1) + np.uint64(1)


def sentence_words(data: np.ndarray, starts: np.ndarray):
    """Of a block: features (one row for each kind) of the words, the sentence of
    each word, begin and end (bytes) and piece of each sentence."""
    begin, end = word_spans(data, IS_LETTER)
    if not len(begin):
        empty = np.zeros(0, np.int64)
        return np.zeros((1 + len(HEADS), 0), np.int32), empty, empty, empty, empty
    low = LOWER[data]
    length = end - begin
    *heads, whole = head_hashes(low, begin, length, (*HEADS, 16))
    kinds = [_bucket(whole ^ (length.astype(np.uint64) << np.uint64(40)))]
    for k, h in zip(HEADS, heads):
        h = _bucket((h ^ np.uint64(k * 0x9E3779B1)) * np.uint64(0xD6E8FEB86659FD93))
        h[length <= k] = 0  # bucket 0 has weight 0
        kinds.append(h)
    stop = np.flatnonzero(ENDS[data])
    raw = np.searchsorted(stop, begin)
    new = np.concatenate(([True], raw[1:] != raw[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    until = np.append(stop, len(data))[raw[first]]
    return (np.array(kinds, np.int32), np.cumsum(new) - 1, begin[first],
            np.maximum(end[last], np.minimum(until + 1, len(data) - 1)), np.searchsorted(starts, begin[first], side="right") - 1)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def train(features: list[np.ndarray], sentences: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 100,
          rate: float = 0.5, decay: float = 1e-6, start: float = -7.0, seed: int = 11) -> np.ndarray | None:
    """Weights, the last being the bias. ``features[d]``: kinds x words;
    ``sentences[d]``: the sentence of each word, from 0."""
    if not len(y) or y.min() == y.max():
        return None
    w, square = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-2)
    w[-1] = start
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), batch):
            docs = [d for d in order[at:at + batch] if len(sentences[d])]
            if not docs:
                continue
            f = np.concatenate([features[d] for d in docs], axis=1)
            n = np.array([sentences[d][-1] + 1 for d in docs])
            base = np.concatenate(([0], np.cumsum(n)))
            s = np.concatenate([sentences[d] + b for d, b in zip(docs, base)])
            z = np.bincount(s, w[f].sum(0), minlength=base[-1]) + w[-1]
            total = np.add.reduceat(softplus(z), base[:-1])
            label = y[docs]
            # d log(1 - e^-S) = e^-S / (1 - e^-S) for label 1, -1 for label 0
            outer = np.where(label > 0, 1 / np.expm1(np.clip(total, 1e-6, 50)), -1.0)
            g_s = np.repeat(np.clip(outer, -1, 50), n) / (1 + np.exp(-np.clip(z, -60, 60))) / len(docs)
            per_word = g_s[s]
            g = np.bincount(f.ravel(), np.broadcast_to(per_word, f.shape).ravel(), minlength=BUCKETS + 1)
            g -= decay * w
            g[-1] = 0
            square += g * g
            w += rate * g / np.sqrt(square)
            g_b = g_s.sum()
            square[-1] += g_b * g_b
            w[-1] += 0.1 * rate * g_b / np.sqrt(square[-1])
            w[0] = 0
    return w.astype(np.float32)


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        words: list[list[np.ndarray]] = [[] for _ in range(n)]
        where: list[list[np.ndarray]] = [[] for _ in range(n)]
        count = [0] * n
        for data, starts, rows in blocks(utf8(batch["text"])):
            f, s, first, _, piece = sentence_words(data, starts)
            of_word = rows[piece[s]] if len(s) else s
            cut = np.flatnonzero(np.concatenate(([True], of_word[1:] != of_word[:-1]))) if len(s) else []
            for a, b in zip(cut, [*cut[1:], len(s)]):
                r = int(of_word[a])
                words[r].append(f[:, a:b])
                where[r].append(s[a:b] - s[a] + count[r])
                count[r] += int(s[b - 1] - s[a]) + 1
        pack = lambda parts, axis: np.concatenate(parts, axis=axis).astype(np.int32).tobytes() if parts else b""
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), batch["label"], pa.array([pack(x, 1) for x in words], pa.binary()),
             pa.array([pack(x, 0) for x in where], pa.binary())], names=["doc_id", "label", "words", "sentences"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, bound: int = LEARN_ROWS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> np.ndarray | None:
    """Fit on at most ``bound`` labelled rows for which ``learn`` (an expression
    over doc_id) holds."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label_col, bound, learn, id_col, text_col)
    rows = sample.mapInArrow(_featurised, "doc_id long, label int, words binary, sentences binary").toPandas()
    rows = rows.sort_values(["doc_id", "label", "words"], kind="stable")
    return train([np.frombuffer(b, np.int32).reshape(1 + len(HEADS), -1) for b in rows["words"]],
                 [np.frombuffer(b, np.int32) for b in rows["sentences"]], rows["label"].to_numpy(np.float64))


def score(docs: DataFrame, weights: np.ndarray | None, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(doc_id, score, n_sentences, offending)``; offending lists (start, end,
    score) of the sentences whose own score reaches ``threshold``."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            total, seen, found = np.zeros(n), np.zeros(n, np.int64), [[] for _ in range(n)]
            passed = np.zeros(n, np.int64)  # code points of a text in earlier pieces
            for data, starts, rows in blocks(utf8(batch["text"])):
                f, s, begin, end, piece = sentence_words(data, starts)
                code = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
                stop = np.append(starts[1:], len(data)) - 1  # the line feed between pieces is no part of the text
                points = code[stop] - code[starts] + ((data[starts] & 0xC0) != 0x80) - 1
                ahead = np.cumsum(points) - points
                ahead += passed[rows] - ahead[np.searchsorted(rows, rows)]  # of a text's pieces in this block, too
                if weights is not None and len(s):
                    z = np.bincount(s, weights[f].sum(0), minlength=len(begin)) + weights[-1]
                    plus = softplus(z)
                    np.add.at(total, rows[piece], plus)
                    seen += np.bincount(rows[piece], minlength=n)
                    p = -np.expm1(-plus)
                    for k in np.flatnonzero(p >= threshold):
                        origin = code[starts[piece[k]]] - 1 - ahead[piece[k]]
                        found[rows[piece[k]]].append({"start": int(code[begin[k]] - 1 - origin),
                                                      "end": int(code[end[k] - 1] - origin), "score": float(p[k])})
                np.add.at(passed, rows, points)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array((-np.expm1(-total)).round(8)), pa.array(seen),
                                              pa.array(found, kind)],
                                             names=["doc_id", "score", "n_sentences", "offending"])

    texts = keyed_texts(docs, id_col, text_col)
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double, n_sentences long, "
                                 "offending array<struct<start:bigint,end:bigint,score:double>>")


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """The fold of an id: crc32 of its text, by remainder."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts)) == part
