"""Whitening: the solver against dense eigenvectors, the operator against numpy and exact integers."""
import math
import os

import numpy as np
import pytest

from eventide.llm import whitening_jd as W
from eventide.llm.queries import op13_whitening_jd
from llm_fixtures import SMALL

ROWS = "vec_id bigint, embedding array<float>, label int, x string, k int, n int, `a.b` int"


def frame(spark, vectors, ids=None):
    rows = [(k if ids is None else ids[k], v, 1, "x", 2, 3, 4) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, ROWS)


def x_of(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def plain_version(vectors, components=16):
    """Dense covariance and eigenvectors of the distinct fixed vectors."""
    distinct = np.array(sorted({tuple(x_of(v)) for v in vectors}))
    n, sums = len(distinct), distinct.sum(0)
    c = distinct - sums / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    return n, [int(s) for s in sums], e[::-1][:components], u[:, ::-1][:, :components], np.trace(cov)


def compare(vectors, got, components=16):
    n, sums, e, u, trace = plain_version(vectors, components)
    rank = int((e > e[0] * 1e-11).sum())
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    for k, v in enumerate(vectors):
        assert sorted(by[k]) == list(range(1, rank + 1))
        x = x_of(v)
        for r in by[k].values():
            assert (r.n, r.deviation) == (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)))
            assert abs(r.explained - e[r.component - 1] / trace) < 1e-10 and r.identity_error < 1e-9
    gap = lambda j: min([abs(e[j] - o) for i, o in enumerate(e) if i != j] or [1]) / e[0]
    for j in range(rank):
        if gap(j) < 1e-6:
            continue  # any direction of a shared eigenspace will do
        want = (np.array([x_of(v) for v in vectors]) - np.array(sums) / n) @ u[:, j] / math.sqrt(e[j])
        have = np.array([by[k][j + 1].whitened for k in range(len(vectors))])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6


@pytest.mark.parametrize("dim,wanted", [(40, 4), (200, 16), (300, 5)])
@pytest.mark.parametrize("kind", ["flat", "falling", "repeated"])
def test_solver(dim, wanted, kind):
    r = np.random.default_rng(dim + wanted)
    values = {"flat": 1 + r.random(dim) / 50, "falling": 1.3 ** -np.arange(dim),
              "repeated": np.repeat(np.arange(dim // 4, 0, -1), 4)[:dim].astype(float)}[kind]
    q = np.linalg.qr(r.standard_normal((dim, dim)))[0]
    a = (q * values) @ q.T
    passes = [0]

    def product(columns):
        passes[0] += 1
        return a @ columns

    found, vectors = W.jacobi_davidson(product, dim, wanted)
    assert np.abs(found - np.sort(values)[::-1][:wanted]).max() < 1e-12 * values.max()
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12
    assert passes[0] < 400


def test_minres_solves():
    r = np.random.default_rng(3)
    m = r.standard_normal((30, 30))
    a, p = m + m.T, np.linalg.qr(r.standard_normal((30, 2)))[0]
    right = r.standard_normal((30, 3))
    right -= p @ (p.T @ right)
    shifts = np.array([0.0, 1.0, -40.0])
    z = W.minres(lambda c: a @ c, shifts, right, p, 60, 1e-13)
    off = np.eye(30) - p @ p.T
    for k in range(3):
        assert np.linalg.norm(off @ ((a - shifts[k] * np.eye(30)) @ (off @ z[:, k])) - right[:, k]) < 1e-8


def test_whole_table(spark):
    table = spark.read.parquet(os.path.join(SMALL, "embeddings.parquet"))
    rows = sorted(table.collect(), key=lambda r: r.vec_id)
    got = op13_whitening_jd(spark, SMALL).collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    compare([r.embedding for r in rows], got)


def test_wide_vectors(spark):
    """More dimensions than the search space ever holds."""
    r = np.random.default_rng(5)
    mix = r.standard_normal((150, 150)) * np.linspace(3, 0.2, 150)
    vectors = (r.standard_normal((400, 150)) @ mix / 6).astype(np.float32).tolist()
    got = W.whiten(frame(spark, vectors).repartition(3), components=3).collect()
    compare(vectors, got, components=3)


def test_copies_count_once(spark):
    r = np.random.default_rng(6)
    some = r.standard_normal((20, 6)).astype(np.float32).tolist()
    vectors = some + [some[0]] * 300 + [[c + 1e-6 for c in some[1]]]
    compare(vectors, W.whiten(frame(spark, vectors).repartition(4)).collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(8)
    good = r.standard_normal((9, 3)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, inf, 1.0], [-inf, 0.0, 0.0], [1.0, 2.0]]
    ids = [None, 7, 7, *range(100, 106), *range(200, 207)]
    got = W.whiten(frame(spark, good + bad, ids)).collect()
    assert {r.vec_id for r in got} == {None, 7, *range(100, 106)} and len(got) == 9 * 3
    plain = W.whiten(frame(spark, good)).collect()
    assert sorted(r.deviation for r in got) == sorted(r.deviation for r in plain)


def test_no_variance_and_empty(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []], [[0.0, 0.0], [0.001, 0.0]]):
        assert W.whiten(frame(spark, vectors)).collect() == []


def test_rank_below_components(spark):
    r = np.random.default_rng(9)
    vectors = [[float(a), float(b), 5.0, 7.0] for a, b in r.integers(-9, 9, (30, 2))]
    compare(vectors, W.whiten(frame(spark, vectors)).collect())


def test_far_values(spark):
    """Entries far apart: sums stay exact, deviations beyond 64 bits are null."""
    vectors = [[3e38, 1.0], [-3e38, 2.0], [1e15, 3.0], [0.5, 4.0]]
    got = W.whiten(frame(spark, vectors)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3} and {r.deviation for r in got} == {None}
    wide = [[1e6 * k, -2e6 * k * k] for k in range(6)]
    n, sums, *_ = plain_version(wide)
    want = {k: sum((n * a - s) ** 2 for a, s in zip(x_of(v), sums)) for k, v in enumerate(wide)}
    got = {r.vec_id: r.deviation for r in W.whiten(frame(spark, wide)).collect()}
    assert got == {k: v if v < 1 << 63 else None for k, v in want.items()}


def test_passes_run_few_tasks_over_small_blocks(spark, monkeypatch):
    """However many partitions the distinct vectors came in, the passes read them in few."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((400, 8)).astype(np.float32).tolist()
    cores, seen, total = spark.sparkContext.defaultParallelism, [], W._total
    pack = W.pack
    monkeypatch.setattr(W, "pack", lambda x, dim: pack(x.repartition(cores + 40), dim).repartition(cores + 40))
    monkeypatch.setattr(W, "_total", lambda packed, *a: (seen.append(packed.rdd.getNumPartitions()), total(packed, *a))[1])
    compare(vectors, W.whiten(frame(spark, vectors), components=4).collect(), components=4)
    assert len(seen) > 5 and max(seen) <= cores
    monkeypatch.setattr(W, "PASS_BYTES", 400 * 8 * 8 // (cores + 20))
    seen.clear()
    compare(vectors, W.whiten(frame(spark, vectors), components=4).collect(), components=4)
    assert min(seen) == max(seen) >= cores + 20
