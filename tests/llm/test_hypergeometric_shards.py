import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from eventide.llm import hypergeometric_shards as H
from eventide.llm.queries import op6_hypergeometric_shards
from llm_fixtures import none, odd, sf  # noqa: F401


@pytest.mark.parametrize("good,bad,drawn", [(300, 700, 100), (3, 2, 4), (1, 999, 500), (50, 50, 99), (0, 5, 3), (5, 0, 3)])
def test_draws_follow_the_law(good, bad, drawn):
    r = np.random.default_rng(1)
    got = np.array([H.hypergeometric(good, bad, drawn, u) for u in r.random(20_000)])
    assert got.min() >= max(0, drawn - bad) and got.max() <= min(drawn, good)
    want = r.hypergeometric(good, bad, drawn, 20_000) if drawn else got * 0
    assert abs(got.mean() - want.mean()) < 0.05 * max(1, want.std())
    assert abs(got.std() - want.std()) < 0.05 * max(1, want.std())


def test_large_tables_need_no_long_loops():
    n = 30 * 10**9
    assert abs(H.hypergeometric(10**9, n - 10**9, 10**6, 0.5) - 33333) < 3


def test_matrix_has_exact_sums():
    blocks, shards = [10, 0, 7, 83, 1], H.shard_sizes(101, 7)
    for seed in range(50):
        m = H.communication_matrix(blocks, shards, seed)
        assert (m >= 0).all() and m.sum(1).tolist() == blocks and m.sum(0).tolist() == shards


def test_query(spark, sf):
    rows = op6_hypergeometric_shards(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    assert set(by) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_uniform_over_shards_and_slots(spark):
    df = spark.range(2000)
    where = np.zeros((4, 2))
    for seed in range(20):
        for r in H.shuffle(df, 4, ["id"], seed).filter("id in (0, 1)").collect():
            where[r["shard"], r["id"]] += 1
    assert (where.sum(0) == 20).all() and where.max() < 16
    out = H.shuffle(df, 4, ["id"], 3).toPandas()
    assert abs(np.corrcoef(out["id"], out["slot"])[0, 1]) < 0.08 and abs(np.corrcoef(out["id"], out["shard"])[0, 1]) < 0.08


def test_same_rows_again_for_any_partitioning(spark):
    df = spark.range(500)
    a = sorted(map(tuple, H.shuffle(df.repartition(7), 5, ["id"]).collect()))
    assert a == sorted(map(tuple, H.shuffle(df.coalesce(1), 5, ["id"]).collect()))
    assert a != sorted(map(tuple, H.shuffle(df, 5, ["id"], seed=9).collect()))


def test_odd_rows(spark, odd, none):
    out = H.shuffle(odd, 5, ["doc_id", "text"])
    assert out.columns == odd.columns + ["shard", "slot"]
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in odd.collect())
    assert sorted(Counter(r["shard"] for r in rows).values()) == sorted(H.shard_sizes(odd.count(), 5))
    assert H.shuffle(none, 5, ["doc_id", "text"]).count() == 0
    few = H.shuffle(spark.range(3), 24, ["id"]).collect()
    assert len({r["shard"] for r in few}) == 3 and all(r["slot"] == 0 for r in few)


def test_copies_of_one_row_are_spread_over_tasks(spark):
    """A row with 20,000 copies among 4,000 others: sizes and slots stay exact, and no block
    or cell holds more than its share."""
    hot = spark.range(24_000, numPartitions=6).selectExpr("if(id < 20000, -1, id) as id", "'x' as v")
    rows = H.shuffle(hot, 5, ["id"]).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, by.values())) == sorted(H.shard_sizes(24_000, 5))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert Counter(r["id"] for r in rows) == Counter({-1: 20_000, **{k: 1 for k in range(20_000, 24_000)}})
    share = [sum(r["id"] == -1 for r in rows if r["shard"] == s) for s in range(5)]
    assert max(share) - min(share) < 250  # 4,000 +- 26 expected
    placed = hot.select("id", F.monotonically_increasing_id().alias("_place"))
    sizes = placed.groupBy(F.pmod(H._draw(6, 1, ["id"]), F.lit(H.LEAST_BLOCKS))).count().agg(F.max("count")).first()[0]
    assert sizes < 2 * 24_000 / H.LEAST_BLOCKS


def test_law_against_counting(spark):
    """Where three marked rows of 30 go, over many seeds, against the law of drawing without replacement."""
    from math import comb
    df, seen = spark.range(30), Counter()
    runs = 60
    for seed in range(runs):
        placed = {r["id"]: r["shard"] for r in H.shuffle(df, 3, ["id"], seed).collect()}
        seen[sum(placed[k] == 0 for k in range(3))] += 1
    want = [comb(3, k) * comb(27, 10 - k) / comb(30, 10) for k in range(4)]
    assert sum((seen[k] - runs * want[k]) ** 2 / (runs * want[k]) for k in range(4)) < 16.3  # 0.1 % of chi-squared, 3 d. f.
