"""Language-model scores against the smoothing formula applied word by word."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from eventide.llm import lm_backoff as L
from llm_fixtures import documents, none, odd, odd_rows, real_texts  # noqa: F401


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def words_of(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return lower.split() + [L.END]


class PlainModel:
    def __init__(self, rows, order, strength):
        self.order, self.strength, self.counts = order, strength, [Counter() for _ in range(order + 1)]
        for doc_id, text in rows:
            if not held(doc_id):
                seq = [L.START, *words_of(text)]
                for i in range(1, len(seq)):
                    for k in range(1, min(order, i + 1) + 1):
                        self.counts[k][tuple(seq[i - k + 1:i + 1])] += 1
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        self.followed = Counter()
        for k in range(2, order + 1):
            for gram, c in self.counts[k].items():
                self.followed[gram[:-1]] += c

    def p(self, history, word):
        if not history:
            return (self.counts[1][(word,)] + 1) / (self.n + self.v + 1)
        c, ch = self.counts[len(history) + 1][(*history, word)], self.followed[history]
        return (c + self.strength * self.p(history[1:], word)) / (ch + self.strength)

    def row(self, doc_id, text):
        seq = [L.START, *words_of(text)]
        logs = [math.log10(self.p(tuple(seq[max(0, i - self.order + 1):i]), seq[i])) for i in range(1, len(seq))]
        base = [math.log10(self.p((), w)) for w in seq[1:]]
        return (doc_id, held(doc_id), len(logs), sum(self.counts[1][(w,)] > 0 for w in seq[1:]), self.n,
                math.fsum(base), math.fsum(logs))


def compare(rows, got, order, strength):
    model = PlainModel(rows, order, strength)
    key = lambda r: (r[0] is not None, r[0], r[2], r[5])
    want, have = sorted((model.row(*r) for r in rows), key=key), sorted(map(tuple, got), key=key)
    assert len(want) == len(have)
    for w, h in zip(want, have):
        assert w[:5] == h[:5]
        assert h[5] == pytest.approx(w[5], abs=1e-8, rel=1e-10) and h[6] == pytest.approx(w[6], abs=1e-8, rel=1e-10)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_documents(spark, documents, real_texts, order):
    compare(real_texts, L.score(documents.repartition(3), order, 10.0).collect(), order, 10.0)


@pytest.mark.parametrize("order", [2, 3])
def test_small_blocks_parts_and_ranges(spark, documents, real_texts, order, monkeypatch):
    """Texts over several parts and blocks, counts over many ranges."""
    monkeypatch.setattr(L, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(L, "PART_BYTES", 700)
    monkeypatch.setattr(L, "RANGE_BYTES", 50_000)
    assert L.packed(documents, order).count() > 100
    compare(real_texts, L.score(documents, order, 50.0).collect(), order, 50.0)


def test_parts_of_few_words(spark, monkeypatch):
    """Parts with fewer words than the history is long."""
    monkeypatch.setattr(L, "PART_BYTES", 3)
    rows = [(k, "a b a b c a b " * (k % 4) + "a" * (k % 3) + " a bb c") for k in range(40)]
    compare(rows, L.score(spark.createDataFrame(rows, "doc_id int, text string"), 4, 3.0).collect(), 4, 3.0)


def test_odd_rows(odd):
    compare([r[:2] for r in odd_rows()], L.score(odd, 3, 5.0).collect(), 3, 5.0)


def test_empty_table_and_no_training(spark, none):
    assert L.score(none).collect() == []
    only = next(k for k in range(100) if held(k))
    [r] = L.score(spark.createDataFrame([(only, "a b")], "doc_id int, text string")).collect()
    assert tuple(r) == (only, True, 3, 0, 0, 0.0, 0.0)


def test_probabilities_sum_to_one():
    rows = [(k, t) for k, t in enumerate(["a b a c", "b a b", "c c a", "a b c"])]
    model = PlainModel(rows, 3, 2.0)
    for history in ((), (b"a",), (b"a", b"b"), (b"x", b"b"), (L.START,)):
        known = sum(model.p(history, w) for (w,) in model.counts[1])
        assert known + model.p(history, b"never") == pytest.approx(1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aAb \n", max_size=12), min_size=1, max_size=6), st.integers(1, 4))
def test_automaton_of_one_block(texts, order):
    """A block that is the whole corpus: the automaton against the formula."""
    rows = list(enumerate(texts))
    whole = b"".join(t.lower().encode() for t in texts)
    block = {"texts": L.pa.compress(whole, "zstd", asbytes=True), "size": len(whole), "context": [L.START] * len(texts),
             "last": [True] * len(texts), "length": [len(t.encode()) for t in texts], "learn": [not held(k) for k, _ in rows]}
    grams, model = L.Grams(block, order), PlainModel(rows, order, 2.0)
    for d in grams.distinct:
        assert np.all(d[1:] > d[:-1])
    machine = L.Automaton(grams, grams.counts, model.n, model.v, 2.0)
    for (start, end, first), row in zip(grams.spans, rows):
        assert machine.read(start, end, machine.state_at(start - 1, first)) == pytest.approx(model.row(*row)[6], abs=1e-9)
