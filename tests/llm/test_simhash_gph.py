import re
from itertools import combinations

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventide.llm import simhash_gph as G
from eventide.llm.blocks import word_parts
from eventide.llm.components import connected_components
from eventide.llm.queries import op8_simhash_gph
from llm_fixtures import documents, none, odd, real_texts, sf  # noqa: F401


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    s = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB \n\té\x1c\x85😀"), max_size=50))
def test_fingerprint_matches_brute_force(text):
    assert G.fingerprint(text.encode()) == slow_fingerprint(text)


def test_long_texts_are_cut_between_words_only(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    assert b" ".join(word_parts(text.encode(), 100)) == text.encode()
    want = slow_fingerprint(text)
    monkeypatch.setattr(G, "word_parts", lambda t: word_parts(t, 64))
    assert G.fingerprint(text.encode()) == want


def brute(fps, distance):
    return {(min(a, b), max(a, b)) for (a, x), (b, y) in combinations(enumerate(fps), 2) if 0 < bin(x ^ y).count("1") <= distance}


def _linked(spark, fps, distance):
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fps)], "fp bigint, rep bigint")
    return {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in G.links(table, distance).collect()}


def test_links_lose_none_on_skewed_and_correlated_bits(spark):
    r = np.random.default_rng(2)
    fps = set()
    for _ in range(12):  # clusters around centres that share most bits
        centre = int(r.integers(1 << 62)) | 0xFFFF000000000000
        for _ in range(25):
            f = centre
            for b in r.integers(0, 64, int(r.integers(0, 4))):
                f ^= 1 << int(b)
            fps.add(f)
    fps |= {0, 1, 3, (1 << 64) - 1}
    fps = sorted(fps)
    for distance in (1, 2, 3):
        assert _linked(spark, fps, distance) == brute(fps, distance)


def test_thresholds_are_the_cheapest_that_suffice():
    r = np.random.default_rng(4)
    fp = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    x = G._bits(fp).astype(float)
    for m in G.PART_COUNTS:
        parts = G.correlated_parts((x.T @ x).astype(np.int64), len(fp), m)
        assert sorted(b for p in parts for b in p) == list(range(64))
        hist = [[np.bincount(G.gather_bits(fp, s), minlength=1 << len(s)) for s in G.Layout.subs(p)] for p in parts]
        layout = G.Layout.of(parts, 2, hist, len(fp))
        t, cost = layout.thresholds(fp)
        assert ((t + 1).sum(0) == 3).all()
        each = layout.costs(fp)
        for q in range(0, 400, 37):
            best = min(sum(each[i, e, q] for i, e in enumerate(c)) for c in np.ndindex(*[4] * m) if sum(c) == 3)
            assert np.isclose(cost[q], best)


def test_correlated_bits_share_a_part():
    r = np.random.default_rng(5)
    x = r.integers(0, 2, (2000, 64))
    x[:, 40] = x[:, 3]
    x[:, 9] = x[:, 57]
    parts = G.correlated_parts(x.T @ x, 2000, 3)
    where = {b: i for i, p in enumerate(parts) for b in p}
    assert where[40] == where[3] and where[9] == where[57]


def test_components(spark):
    r = np.random.default_rng(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + \
            [(int(a), int(b)) for a, b in r.integers(1000, 1200, (120, 2))] + [(7, 7), (3, 2), (2, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    out = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert out == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_against_brute_force(spark, sf, real_texts):
    out = {r["doc_id"]: r for r in op8_simhash_gph(spark, sf).collect()}
    fps = [slow_fingerprint(t) for _, t in real_texts]
    comp = {i: i for i, _ in real_texts}
    for _ in real_texts:
        change = False
        for (a, x), (b, y) in combinations(zip([i for i, _ in real_texts], fps), 2):
            if bin(x ^ y).count("1") <= 2 and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                change = True
        if not change:
            break
    assert {i: r["component_id"] for i, r in out.items()} == comp
    assert all(out[i]["fingerprint"] == f"{f:016x}" for (i, _), f in zip(real_texts, fps))


def test_odd_rows(spark, odd, none):
    out = G.cluster(odd).collect()
    assert len(out) == odd.count()
    by = {r["doc_id"]: r for r in out}
    assert by[1]["component_id"] == by[2]["component_id"] == by[3]["component_id"] == 1 and by[1]["fp"] == 0
    assert by[7]["component_id"] == 6
    kept = G.keep_one(odd)
    assert kept.schema == odd.schema
    ids = sorted((r["doc_id"] for r in kept.collect() if r["doc_id"] is not None))
    # the null text without an id is a copy of the empty ones, the other text without an id stands alone
    assert ids == [1, 4, 5, 6, 8, 9] and [r["text"] for r in kept.filter("doc_id is null").collect()] == ["no id here at all"]
    assert G.cluster(none).count() == 0 and G.keep_one(none).count() == 0
    assert G.keep_one(odd.filter("doc_id = 7")).count() == 1  # repeated rows: one stays


def test_keep_one_judges_rows_not_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a, 1), (5, b, 2), (3, c, 3), (5, c, 4), (None, a, 5), (None, "alone without an id", 6), (9, b, 7), (9, b, 8), (None, c, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(3)
    kept = sorted((r["n"] for r in G.keep_one(df).collect()))
    assert kept == [1, 2, 3, 6]  # both texts of id 5 stay, every copy goes, under whatever id
    repeated = spark.createDataFrame([(1, a, 1), (1, a, 1), (1, a, 2), (None, b, 3), (None, b, 3)], "doc_id bigint, text string, n int")
    assert sorted(r["text"] == a for r in G.keep_one(repeated).collect()) == [False, True]


def test_shared_ids_join_no_components(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    df = spark.createDataFrame([(5, a), (5, b), (1, a), (7, b), (8, c), (None, c)], "doc_id bigint, text string")
    out = {(r["doc_id"], r["fp"]): r["component_id"] for r in G.cluster(df).collect()}
    assert sorted(((i is None, i), v) for (i, _), v in out.items()) == [
        ((False, 1), 1), ((False, 5), 1), ((False, 5), 5), ((False, 7), 5), ((False, 8), 8), ((True, None), 8)]


def test_same_result_for_any_partitioning(spark, documents):
    few = G.cluster(documents.coalesce(1)).agg(F.sum(F.xxhash64("doc_id", "fp", "component_id").cast("decimal(38,0)"))).first()
    many = G.cluster(documents.repartition(7)).agg(F.sum(F.xxhash64("doc_id", "fp", "component_id").cast("decimal(38,0)"))).first()
    assert few == many
