"""Quality by attention and toxicity by noisy-or."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from eventide.llm import quality_attention as A, toxicity_mil as T
from eventide.llm.blocks import blocks, labelled_sample, pieces, utf8, word_hashes
from eventide.llm.queries import op1_quality_attention, op10_toxicity_mil
from llm_fixtures import documents, labels, none, odd  # noqa: F401

MID = "/root/testdata/sf0.1"


def _auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


@pytest.mark.parametrize("query,label,least", [(op1_quality_attention, "quality", 0.98), (op10_toxicity_mil, "toxic", 0.93)])
def test_held_out_accuracy(spark, query, label, least):
    out = query(spark, MID)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    seen = out.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").toPandas()
    assert seen.score.between(0, 1).all()
    rest = seen[seen.held_out]
    assert _auc(rest.score.to_numpy(), rest[label].to_numpy()) > least
    assert (rest.predicted == rest[label]).mean() > 0.95


def test_gradients_match_differences():
    r = np.random.default_rng(1)
    x, bag, y = r.random((9, A.WIDTH)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 2]), np.array([1.0, 0.0, 1.0])
    m = A.Model.start(x, 5, 4, 0.6, 2)

    def loss():
        p = m.score(*m.pooled(x, bag, 3))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = m.gradients(x, bag, y, 0.0)
    for name in ("W", "b", "V", "U", "a", "c", "d"):
        flat = m.p[name].reshape(-1)
        k = int(r.integers(len(flat)))
        old, eps = flat[k], 1e-5
        flat[k] = old + eps
        up = loss()
        flat[k] = old - eps
        down = loss()
        flat[k] = old
        assert g[name].reshape(-1)[k] == pytest.approx((up - down) / 2 / eps, rel=1e-3, abs=1e-7), name


def test_attention_picks_the_telling_passage():
    r = np.random.default_rng(3)
    x, bag, y = [], [], []
    for d in range(300):
        n = int(r.integers(1, 8))
        p = r.normal(0, 1, (n, A.WIDTH))
        label = int(r.integers(2))
        if label:
            p[int(r.integers(n)), :8] += 4
        x.append(p)
        bag += [d] * n
        y.append(label)
    x, bag, y = np.concatenate(x), np.array(bag), np.array(y, float)
    m = A.train(x, bag, y, epochs=15)
    assert _auc(m.score(*m.pooled(x, bag, len(y))), y) > 0.95


def test_blocks_do_not_change_features():
    text = ("alpha beta. gamma! " * 4000).encode()
    assert b"".join(pieces(text, 1000)) == text
    whole = sum(len(T.sentence_words(d, s)[2]) for d, s, _ in blocks([text], 1 << 30))
    parts = sum(len(T.sentence_words(d, s)[2]) for d, s, _ in blocks([text], 1 << 10))
    assert whole == parts == 8000


def test_sentences_are_located(spark):
    r = np.random.default_rng(5)
    plain = ["alpha", "beta", "gamma", "delta", "été", "größe"]
    rows, labels = [], []
    for d in range(600):
        sentences = [" ".join(r.choice(plain, 6)) + "." for _ in range(5)]
        toxic = d % 3 == 0
        if toxic:
            sentences[int(r.integers(5))] = "éa rotten zzbad word."
        rows.append((d, " ".join(sentences)))
        labels.append((d, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    w = T.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    out = {x["doc_id"]: x for x in T.score(docs, w).collect()}
    text = dict(rows)
    for d, toxic in labels:
        assert (out[d]["score"] >= 0.5) == bool(toxic)
        if toxic:
            [s] = out[d]["offending"]
            assert text[d][s["start"]:s["end"]] == "éa rotten zzbad word."


def test_long_text_positions(spark):
    text = ("é word here.\n" * 120_000) + "zzbad thing."
    w = np.zeros(T.BUCKETS + 1, np.float32)
    w[-1] = -20
    f = T.sentence_words(np.frombuffer(b"zzbad\n", np.uint8), np.zeros(1, np.int64))[0]
    w[f[0]] = 40
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    [row] = T.score(df, w).collect()
    [s] = row["offending"]
    assert text[s["start"]:s["end"]] == "zzbad thing." and row["n_sentences"] == 120_001


@pytest.mark.parametrize("module,label", [(A, "quality"), (T, "toxic")])
def test_odd_rows(spark, odd, none, documents, labels, module, label):
    model = module.fit(documents, labels)
    out = module.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r["score"] for r in out}
    assert by[1] == by[2] == by[3]
    assert len({r["score"] for r in out if r["doc_id"] in (6, 7)}) == 1
    assert module.score(none, model).count() == 0
    assert module.fit(none, labels) is None and module.fit(documents, labels.filter(f"{label} = 1")) is None
    assert module.score(odd, None).count() == odd.count()


def test_null_texts_are_empty():
    import pyarrow as pa
    assert utf8(pa.array(["a", None, "é"])) == [b"a", b"", "é".encode()]


# --- the same scores in plain Python, a word and a byte at a time ------------------------

M64 = (1 << 64) - 1


def slow_heads(word, widths):
    h, out = 0x9E3779B97F4A7C15, {}
    for j in range(max(widths)):
        h = ((h ^ (word[j] + 1 if j < len(word) else 0)) * 0x100000001B3) & M64
        h ^= h >> 29
        if j + 1 in widths:
            out[j + 1] = h
    return out


def slow_toxicity(text, w):
    data, sentences, at = text + b"\n", {}, 0
    for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", data):
        word = bytes(b + 32 if 65 <= b <= 90 else b for b in m[0])
        heads = slow_heads(word, (*T.HEADS, 16))
        z = w[((heads[16] ^ len(word) << 40) >> 20) % (T.BUCKETS - 1) + 1]
        for k in T.HEADS:
            if len(word) > k:
                z += w[((((heads[k] ^ k * 0x9E3779B1) * 0xD6E8FEB86659FD93) & M64) >> 20) % (T.BUCKETS - 1) + 1]
        number = sum(b in b".!?\n" for b in data[at:m.start()]) + max(sentences, default=0) if sentences else 0
        at = m.start()
        sentences[number] = sentences.get(number, 0.0) + float(z)
    good = 1.0
    for z in sentences.values():
        good *= math.exp(-float(np.logaddexp(0, z + float(w[-1]))))
    return 1 - good, len(sentences)


def slow_quality(text, p):
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    bags = []
    for k in range(0, len(words), A.PASSAGE_WORDS):
        own = words[k:k + A.PASSAGE_WORDS]
        body = text[own[0][0]:own[-1][1]]
        x = np.zeros(A.WIDTH)
        for b in body:
            x[A.CLASS[b]] += 1 / len(body)
        pairs = Counter(((a * 31 + b) * 40503 >> 5) & (A.PAIR_BUCKETS - 1) for a, b in zip(body, body[1:]))
        for q, n in pairs.items():
            x[16 + q] = math.sqrt(n / len(body))
        each = [text[a:b] for a, b in own]
        x[-4] = sum(a == b for a, b in zip(each, each[1:])) / len(each)
        x[-3] = len(set(each)) / len(each)
        x[-2] = sum(map(len, each)) / len(each) / 10
        x[-1] = math.log1p(len(each)) / 5
        bags.append(x)
    top, below = 0, 0
    for x in bags or [np.zeros(A.WIDTH)]:
        h = np.tanh(((x - p["mean"]) * p["scale"]) @ p["W"] + p["b"])
        e = math.exp(min(30, max(-30, float((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["a"]))))
        top, below = top + e * h, below + e
    return 1 / (1 + math.exp(-float((top / below) @ p["c"] + p["d"][0]))), len(bags)


ODD_TEXTS = ["", " \n", "one", "a" * 40 + " " + "a" * 39 + "b " + "a" * 40, "x y x y x x. Z! é中 ok?\n\nno", "word " * 200]


@pytest.mark.parametrize("module,slow,label", [(A, slow_quality, "quality"), (T, slow_toxicity, "toxic")])
def test_scores_against_plain_python(spark, module, slow, label):
    """Every document of the table, and texts with words that share their beginnings."""
    small = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    model = module.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    odd_ = spark.createDataFrame([(-k - 1, t) for k, t in enumerate(ODD_TEXTS)], "doc_id bigint, text string")
    texts = {r["doc_id"]: r["text"].encode() for r in docs.union(odd_).collect()}
    rows = module.score(docs.union(odd_), model).collect()
    assert len(rows) == len(texts) > 1000
    for r in rows:
        score, parts = slow(texts[r["doc_id"]], model.p if module is A else model)
        assert r["score"] == pytest.approx(score, abs=2e-4) and r[2] == parts, r["doc_id"]


def test_sample_has_one_row_an_id_and_its_bounds(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(k, "y" * 100) for k in range(2, 60)] + [(99, "z" * 5000), (1, None)],
                                 "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 120)], "doc_id bigint, quality int")
    rows = labelled_sample(docs, labels, "quality", 1000).collect()
    assert sorted(r["doc_id"] for r in rows) == [*range(1, 60), 99]
    again = labelled_sample(docs.repartition(2), labels, "quality", 1000).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    few = labelled_sample(docs, labels, "quality", 1000, max_bytes=3200).collect()
    assert 25 <= len(few) <= 33 and sum(len(r["text"]) for r in few) <= 3200 and 99 not in {r["doc_id"] for r in few}
    assert len(labelled_sample(docs, labels, "quality", 7).collect()) <= 7


def test_ids_that_are_no_numbers(spark, documents, labels):
    from pyspark.sql import functions as F
    name = F.concat(F.lit("doc-"), F.col("doc_id"))
    for module in (A, T):
        model = module.fit(documents.withColumn("doc_id", name), labels.withColumn("doc_id", name))
        assert module.score(documents.withColumn("doc_id", name), model).count() == documents.count()


def test_hashes_of_whole_words():
    words = [b"a" * 40, b"a" * 39 + b"b", b"a" * 41, b"b", b"ab", b"ba", b"\x00", b"\x00\x00"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    h = word_hashes(data, end - [len(w) for w in words], end)
    assert len(set(h.tolist())) == len(words)
