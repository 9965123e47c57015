"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words. A passage is described
by shares of byte classes, hashed byte pairs and repetition, encoded by a
learned layer, and weighted by learned gated attention; the weighted passage
representation is scored by a logistic unit. Document labels train all of it
(plain numpy, on a bounded sample); every passage of every text is then scored
on the executors. Attention sums add up over the blocks of a text, so a text
of any length is scored whole in bounded memory.

Defined results: a null or empty text is a bag of one all-zero passage;
repeated rows get equal scores; an empty table gives an empty result; without
labels of both kinds the score is 0.5 everywhere. Only id and text are read. The fit
takes at most LEARN_ROWS rows and ``blocks.SAMPLE_BYTES`` of text, one row an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import (blocks, keyed_texts, labelled_sample, small_batches, utf8, word_hashes,
                                 word_spans)

PASSAGE_WORDS = 64
PAIR_BUCKETS = 256
#: Labelled rows the model is fitted on, at most.
LEARN_ROWS = 4_000

#: Byte classes: blanks, line feed, lower, upper, digits, sentence ends, inner
#: marks, exclamation, symbols (two kinds), bar, brackets and quotes, other
#: ASCII, first bytes and following bytes of other letters, controls.
_CLASSES = 16


def _class_table() -> np.ndarray:
    table = np.full(256, 12, np.int64)
    for k, members in enumerate((b" \t\r", b"\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789",
                                 b".?", b",;:", b"!", b"#*", b"$%&", b"|", b"\"'()[]{}<>")):
        table[list(members)] = k
    table[0xC0:] = 13
    table[0x80:0xC0] = 14
    table[:9] = 15
    return table


CLASS = _class_table()
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
WIDTH = _CLASSES + PAIR_BUCKETS + 4


def passages(data: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of a block, and the text each belongs to."""
    begin, end = word_spans(data, IS_WORD)
    if not len(begin):
        return np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64)
    piece = np.searchsorted(starts, begin, side="right") - 1
    new = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
    within = np.arange(len(begin)) - np.repeat(new, np.diff(np.append(new, len(begin))))
    first = np.flatnonzero(within % PASSAGE_WORDS == 0)
    n = len(first)
    of_word = np.repeat(np.arange(n), np.diff(np.append(first, len(begin))))
    # bytes between passages belong to none, so a text's neighbours do not matter
    until = end[np.append(first[1:], len(begin)) - 1]
    size = (until - begin[first]).astype(np.float64)
    gap = np.append(begin[first[1:]], until[-1]) - until
    of_byte = np.repeat(np.stack((np.arange(n), np.full(n, n)), 1).ravel(), np.stack((until - begin[first], gap), 1).ravel())
    body = data[int(begin[0]):int(until[-1])]
    out = np.empty((n, WIDTH), np.float32)
    out[:, :_CLASSES] = np.bincount(of_byte * _CLASSES + CLASS[body],
                                    minlength=(n + 1) * _CLASSES).reshape(n + 1, -1)[:n] / size[:, None]
    wide = body.astype(np.int64)
    pair = ((wide[:-1] * 31 + wide[1:]) * 40503 >> 5) & (PAIR_BUCKETS - 1)
    home = np.where(of_byte[:-1] == of_byte[1:], of_byte[:-1], n)
    found = np.bincount(home * PAIR_BUCKETS + pair, minlength=(n + 1) * PAIR_BUCKETS)
    out[:, _CLASSES:_CLASSES + PAIR_BUCKETS] = np.sqrt(found.reshape(n + 1, -1)[:n] / size[:, None])
    words = np.bincount(of_word, minlength=n)
    h = word_hashes(data, begin, end)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    order = np.lexsort((h, of_word))
    fresh = np.ones(len(h))
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
    out[:, -4] = np.bincount(of_word, same, minlength=n) / words
    out[:, -3] = np.bincount(of_word[order], fresh, minlength=n) / words
    out[:, -2] = np.bincount(of_word, end - begin, minlength=n) / words / 10
    out[:, -1] = np.log1p(words) / 5
    return out, rows[piece[first]]


@dataclass
class Model:
    """Weights: input scale, encoder, attention (value and gate), score."""
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def start(cls, x: np.ndarray, hidden: int, attention: int, rate: float, seed: int) -> Model:
        r = np.random.default_rng(seed)
        w = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape)
        return cls({"mean": x.mean(0), "scale": 1 / (x.std(0) + 1e-2),
                    "W": w(WIDTH, hidden), "b": np.zeros(hidden), "V": w(hidden, attention),
                    "U": w(hidden, attention), "a": w(attention), "c": w(hidden),
                    "d": np.array([np.log(rate / (1 - rate))])})

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.p["mean"]) * self.p["scale"]) @ self.p["W"] + self.p["b"])

    def attend(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v, g = np.tanh(h @ self.p["V"]), 1 / (1 + np.exp(-(h @ self.p["U"])))
        return np.exp(np.clip((v * g) @ self.p["a"], -30, 30)), v, g

    def pooled(self, x: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums over each text of weight times representation, and of weights."""
        h = self.encode(x)
        e = self.attend(h)[0]
        top, below = np.zeros((n, h.shape[1])), np.zeros(n)
        np.add.at(top, rows, e[:, None] * h)
        np.add.at(below, rows, e)
        return top, below

    def score(self, top: np.ndarray, below: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((top / below[:, None]) @ self.p["c"] + self.p["d"][0], -30, 30)))

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        """Of the mean log loss over a batch of bags; ``bag`` is sorted."""
        p, n = self.p, len(y)
        z = (x - p["mean"]) * p["scale"]
        h = self.encode(x)
        e, v, g = self.attend(h)
        first = np.searchsorted(bag, np.arange(n))
        below = np.add.reduceat(e, first)
        w = e / below[bag]
        rep = np.add.reduceat(w[:, None] * h, first)
        delta = (self.score(rep, np.ones(n)) - y) / n
        out = {"c": rep.T @ delta, "d": np.array([delta.sum()])}
        d_rep = delta[:, None] * p["c"]
        d_h = w[:, None] * d_rep[bag]
        d_a = w * ((h - rep[bag]) * d_rep[bag]).sum(1)  # through the softmax
        d_vg = d_a[:, None] * p["a"]
        out["a"] = (v * g).T @ d_a
        d_v, d_g = d_vg * g * (1 - v * v), d_vg * v * g * (1 - g)
        out["V"], out["U"] = h.T @ d_v, h.T @ d_g
        d_h += d_v @ p["V"].T + d_g @ p["U"].T
        d_z = d_h * (1 - h * h)
        out["W"], out["b"] = z.T @ d_z, d_z.sum(0)
        return {k: out[k] + decay * p[k] * (p[k].ndim > 1) for k in out}


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, hidden: int = 24, attention: int = 12,
          epochs: int = 12, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model | None:
    """Adam over batches of whole bags. None if the labels are of one kind only."""
    if not len(y) or y.min() == y.max():
        return None
    model = Model.start(x, hidden, attention, y.mean(), seed)
    first = np.searchsorted(bag, np.arange(len(y) + 1))
    m = {k: 0 for k in model.p}
    s = {k: 0 for k in model.p}
    random, step = np.random.default_rng(seed), 0
    total = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), batch):
            docs = np.sort(order[at:at + batch])
            take = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            local = np.repeat(np.arange(len(docs)), first[docs + 1] - first[docs])
            step += 1
            for k, gr in model.gradients(x[take], local, y[docs], decay).items():
                m[k] = 0.9 * m[k] + 0.1 * gr
                s[k] = 0.99 * s[k] + 0.01 * gr * gr
                model.p[k] = model.p[k] - rate * (1 - step / (total + 1)) * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got: dict[int, list[np.ndarray]] = {}
        for data, starts, rows in blocks(utf8(batch["text"])):
            x, of = passages(data, starts, rows)
            for row in np.unique(of):
                got.setdefault(int(row), []).append(x[of == row])
        bags = [np.concatenate(got[i]) if i in got else np.zeros((1, WIDTH), np.float32)
                for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), batch["label"], pa.array([b.tobytes() for b in bags], pa.binary())],
            names=["doc_id", "label", "bag"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, bound: int = LEARN_ROWS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on at most ``bound`` labelled rows for which ``learn`` (an expression
    over doc_id) holds."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label_col, bound, learn, id_col, text_col)
    rows = sample.mapInArrow(_bags, "doc_id long, label int, bag binary").toPandas()
    rows = rows.sort_values(["doc_id", "label", "bag"], kind="stable")
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows["bag"]]
    if not bags:
        return None
    return train(np.concatenate(bags).astype(np.float64), np.repeat(np.arange(len(bags)), [len(b) for b in bags]),
                 rows["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, n_passages)`` of every whole text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            out, seen = np.full(n, 0.5), np.zeros(n, np.int64)
            if model is not None and n:
                top, below = np.zeros((n, len(model.p["b"]))), np.zeros(n)
                for data, starts, rows in blocks(utf8(batch["text"])):
                    x, of = passages(data, starts, rows)
                    t, w = model.pooled(x, of, n)
                    top, below = top + t, below + w
                    seen += np.bincount(of, minlength=n)
                bare = np.flatnonzero(seen == 0)
                t, w = model.pooled(np.zeros((len(bare), WIDTH)), bare, n)
                out = model.score(top + t, below + w).round(8)  # sums differ in their last digits by block
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out), pa.array(seen)],
                                             names=["doc_id", "score", "n_passages"])

    texts = keyed_texts(docs, id_col, text_col)
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double, n_passages long")


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """The fold of an id: crc32 of its text, by remainder."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts)) == part
