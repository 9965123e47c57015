from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from eventide.llm import decontaminate as D
from eventide.llm.queries import op2_decontaminate
from llm_fixtures import none, odd, sf  # noqa: F401


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, items, similarity=0.8):
    """Every window of every length against every item."""
    out = {}
    for d, text in docs:
        words = D.exact_words((text or "").encode())
        for i, item in items:
            target = D.exact_words(item.encode())
            k = D.allowed_edits(len(target), similarity)
            if len(target) < D.MIN_WORDS:
                continue
            best = min((lev(target, words[s:s + n]) for s in range(len(words)) for n in range(1, len(target) + k + 1)), default=99)
            if best <= k:
                out[d, i] = best
    return out


def test_small_corpus_against_brute_force(spark):
    r = np.random.default_rng(0)
    word = lambda: f"w{r.integers(12)}"
    items = [(i, " ".join(word() for _ in range(int(r.integers(5, 14))))) for i in range(12)] + [(50, "too few"), (51, "")]
    docs = []
    for d in range(80):
        words = [f"x{r.integers(30)}" if r.random() < 0.6 else word() for _ in range(25)]
        if d % 2:
            copy = items[int(r.integers(12))][1].split()
            for _ in range(int(r.integers(0, 3))):
                at = int(r.integers(len(copy)))
                copy[at:at + 1] = [["zz"], [], [copy[at], "yy"]][int(r.integers(3))]
            words[5:5] = copy
        docs.append((d, " ".join(words)))
    docs += [(100, items[0][1]), (101, items[1][1].upper().replace(" ", " , ")), (102, items[2][1].rsplit(" ", 1)[0])]
    want = brute(docs, items)
    got = {(x["doc_id"], x["item_id"]): x["distance"] for x in D.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"),
        recall=0.999).collect()}
    assert set(got) <= set(want) and all(got[p] == want[p] for p in got)
    assert len(got) >= 0.95 * len(want)
    assert {p for p in want if want[p] == 0} <= set(got)


def test_recall_with_the_most_edits(spark, sf):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    targets, r = D.Targets(items, 0.8, 0.99), np.random.default_rng(1)
    found = total = 0
    for i, text in items:
        words = text.split()
        for _ in range(D.allowed_edits(len(D.exact_words(text.encode())), 0.8)):
            at = int(r.integers(len(words)))
            words[at:at + 1] = [[f"zz{at}"], [words[at], f"qq{at}"], []][int(r.integers(3))]
        hits = D._scan([("foo bar " + " ".join(words) + " baz").encode()], targets)
        found += any(k[1] == i for k in hits)
        total += 1
    assert found >= 0.95 * total


def _recall(items, targets, r, copies=1):
    """By size, the share of copies with the most edits in which the item is found."""
    hashes, base, of = [], [0], []
    for i, text in items * copies:
        words = text.split()
        of.append((i, len(words)))
        for e in range(D.allowed_edits(len(words), 0.8)):
            at = int(r.integers(len(words)))
            words[at:at + 1] = [[f"zz{e}"], [words[at], f"qq{e}"], []][int(r.integers(3))]
        text = ("foo bar " + " ".join(words) + " baz" * 9).encode()
        hashes += [D.words_of(np.frombuffer(text, np.uint8))[0], np.full(targets.gap, D._PAD)]
        base.append(base[-1] + len(hashes[-2]) + targets.gap)
    start, target = targets.find(np.concatenate(hashes))
    row = np.searchsorted(base, start, side="right") - 1
    hit = {k for k, t in zip(row.tolist(), target.tolist()) if targets.item[t] == of[k][0]}
    total, found = Counter(n for _, n in of), Counter(of[k][1] for k in hit)
    return {n: found[n] / total[n] for n in total}


def test_recall_of_long_items_among_short_ones():
    r = np.random.default_rng(2)
    sizes = [60] * 20 + [128] * 20 + [256] * 20 + [8] * 1200
    items = [(i, " ".join(f"w{r.integers(5000)}" for _ in range(n))) for i, n in enumerate(sizes)]
    targets = D.Targets(items, 0.8, 0.99)
    got = _recall(items[:60], targets, r, copies=15) | _recall(items[60:], targets, r)
    assert set(got) == {8, 60, 128, 256} and min(got.values()) >= 0.99, got


def test_sizes_of_too_many_repetitions_are_compared_exactly(monkeypatch):
    monkeypatch.setattr(D, "EXACT_AFTER", 20)
    r = np.random.default_rng(4)
    items = [(i, " ".join(f"w{r.integers(500)}" for _ in range(n))) for i, n in enumerate([8] * 40 + [128] * 40)]
    targets = D.Targets(items, 0.8, 0.99)
    assert targets.repetitions[8] and targets.repetitions[128] is None
    assert _recall(items, targets, r)[128] == 1


def test_query_finds_the_verbatim_copies(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]): r for r in op2_decontaminate(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    exact = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    assert exact and exact <= set(got)
    texts = {d["doc_id"]: d["text"] for d in docs}
    for (d, i) in exact:
        assert got[d, i]["distance"] == 0
        span = texts[d][got[d, i]["start"]:got[d, i]["end"]]
        item = next(x["text"] for x in items if x["item_id"] == i)
        assert D.exact_words(span.encode()) == D.exact_words(item.encode())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=8), st.lists(st.integers(0, 3), max_size=12))
def test_distance_to_a_prefix(a, b):
    best, used = D.edit_distance_to_prefix(a, b)
    every = [lev(a, b[:n]) for n in range(len(b) + 1)]
    assert best == min(every) and used == every.index(best)
    h = lambda x: np.array(x, np.uint64) * np.uint64(977) + np.uint64(5)
    assert D._distances(h([a]), h([b]).reshape(1, -1))[0] == best


def test_windows_over_the_edges_of_parts():
    item = " ".join(f"k{i}" for i in range(30))
    targets = D.Targets([(1, item)], 0.8, 0.99)
    for pad in range(0, 400, 13):
        text = ("pad " * pad + item + " tail" * 50).encode()
        hits = D._scan([text], targets, limit=300)
        assert list(hits) == [(0, 1)]
        assert text[hits[0, 1][1]:hits[0, 1][2]].decode() == item


def test_long_items_are_searched_in_parts(spark):
    item = " ".join(f"k{i}" for i in range(1000))
    docs = spark.createDataFrame([(1, "a b " + item), (2, " ".join(f"k{i}" for i in range(100, 420))), (3, "k1 k2 k3")], "doc_id bigint, text string")
    got = {r["doc_id"] for r in D.leaks(docs, spark.createDataFrame([(9, item)], "item_id bigint, text string")).collect()}
    assert got == {1, 2} or got == {1}
    assert 1 in got and 3 not in got


def test_scripts_without_spaces_and_letters_of_every_script(spark):
    items = [(1, "机器学习是人工智能的一个分支，它使计算机能够从数据中学习。"), (2, "ÉTÉ ÀÂ ŒUVRE ÇA ÎLE ÜBER"), (3, "ПРИВЕТ МИР КАК ТВОИ ДЕЛА"),
             (4, "ΚΑΛΗΜΕΡΑ ΚΟΣΜΕ ΤΙ ΚΑΝΕΙΣ ΕΔΩ"), (5, "สวัสดีชาวโลกวันนี้อากาศดี"), (6, "𠀀𠀁𠀂𠀃𠀄𠀅")]
    docs = [(1, "前言。" + items[0][1] + "后记。"), (10, "前言。机器学习是人工智能的一个分支它使计算机能够从数据中自学。"),
            (2, "x été àâ œuvre ça île über y"), (3, "он сказал привет мир как твои дела и ушёл"), (4, "καλημερα κοσμε τι κανεισ εδω"),
            (5, "ก" + items[4][1]), (6, "a" + items[5][1]), (7, "今天天气很好，我们去公园散步吧，孩子们都很高兴。"), (8, "other words stand here alone")]
    got = {(x["doc_id"], x["item_id"]): x["distance"] for x in D.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {(1, 1): 0, (10, 1): got[10, 1], (2, 2): 0, (3, 3): 0, (4, 4): got[4, 4], (5, 5): 0, (6, 6): 0} and got[10, 1] >= 1
    [first] = [x for x in D.leaks(spark.createDataFrame(docs[:1], "doc_id bigint, text string"),
                                  spark.createDataFrame(items[:1], "item_id bigint, text string")).collect()]
    assert docs[0][1][first["start"]:first["end"]] == items[0][1].rstrip("。")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB éÉ中。國ก𠀀İ😀-\n", max_size=30))
def test_words_of_any_text(text):
    raw = text.encode()
    words = D.exact_words(raw)
    assert all(words) and len(D.words_of(np.frombuffer(raw, np.uint8))[1]) == len(words)
    assert [w for w in D.exact_words(text.replace("É", "é").replace("B", "b").encode())] == words
    assert sum(w in ("中".encode(), "國".encode()) for w in words) == text.count("中") + text.count("國")


def test_rows_are_judged_by_their_text(spark):
    item = "one two three four five six seven eight"
    rows = [(1, "clean text under a shared id " * 3), (1, f"leak {item} leak"), (None, f"again {item}"), (None, "clean without an id"), (2, None)]
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = D.drop_leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()
    assert Counter(map(tuple, kept)) == Counter([rows[0], rows[3], rows[4]])


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    r = np.random.default_rng(3)
    items = [(i, " ".join(f"t{r.integers(1000)}" for _ in range(9))) for i in range(60)]
    docs = spark.createDataFrame([(i, f"some words {t} more words") for i, t in items], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(D, "ITEM_ROWS", 10)
    assert {(x["doc_id"], x["item_id"]) for x in D.leaks(docs, bench).collect()} >= {(i, i) for i, _ in items}


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (3, "a b"), (None, "one two three four five six")]])
def test_odd_items(spark, odd, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert D.leaks(odd, bench).count() == 0
    kept = D.drop_leaks(odd, bench)
    assert kept.schema == odd.schema and kept.count() == odd.count()


def test_odd_rows(spark, odd, none):
    long = odd.filter("doc_id = 6").first()["text"]
    piece = " ".join(long.split()[30_000:30_040])
    bench = spark.createDataFrame([(1, piece), (1, piece)], "item_id bigint, text string")
    got = sorted((r["doc_id"], r["distance"]) for r in D.leaks(odd, bench).collect())
    assert got == [(6, 0), (7, 0), (7, 0)]
    assert sorted(str(r["doc_id"]) for r in D.drop_leaks(odd, bench).select("doc_id").collect()) == sorted(
        str(x) for x in (1, 2, 3, 4, 5, 8, 9, None, None))
    assert D.leaks(none, bench).count() == 0 and D.drop_leaks(none, bench).count() == 0
