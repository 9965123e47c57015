"""The pipeline, stage by stage against brute force, and the registration."""
import os
import subprocess
import sys

import public_tokenizers as P
import tiktoken

import __spark_entry__ as E
import corpus_pipeline as C
from eventide.llm import bpe_replay, decontaminate, quality_rules
from test_simhash_gph import slow_fingerprint
from test_spans import slow_secrets
from llm_fixtures import odd  # noqa: F401

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
MID = "/root/testdata/sf0.01"


def test_the_operators_and_the_pipeline_are_registered():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


def test_without_the_operators_the_rest_imports():
    code = "import sys; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as E\n" \
           "print(sorted(k for k in E.queries() if k.startswith('op')), len(E.oracle_sql()) > 20)"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert said.stdout.strip() == "[] True", said.stderr


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    columns, texts = docs.columns, None
    for k, (name, stage) in enumerate(C.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        path = str(tmp_path / str(k))
        stage(spark, docs, MID).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"]: r for r in docs.collect()}
        if k < len(C.STAGES) - 1:
            assert docs.columns == columns and set(after) <= set(before)
        if name == "quality rules":
            gone = set(before) - set(after)
            short = {i for i, r in before.items() if quality_rules.text_counts(r["text"].encode())[0] < 50}
            assert short <= gone
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
            assert all(labels.get(i) != 0 or i in gone for i in before if i in labels) or \
                sum(labels.get(i) == 0 for i in after) <= 2
            assert sum(labels.get(i) == 1 and i not in short for i in gone) <= 5
        elif name == "simhash near-dedup":
            fps = {i: slow_fingerprint(r["text"]) for i, r in before.items()}
            ids, comp = sorted(fps), {i: i for i in fps}
            changed = True
            while changed:
                changed = False
                for x, a in enumerate(ids):
                    for b in ids[x + 1:]:
                        if comp[a] != comp[b] and bin(fps[a] ^ fps[b]).count("1") <= 2:
                            comp[a] = comp[b] = min(comp[a], comp[b])
                            changed = True
            assert set(after) == {i for i in ids if comp[i] == i}
        elif name == "benchmark decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{MID}/benchmark.parquet").collect()]
            leaking = {i for i, r in before.items() if any(t in r["text"] for t in items)}
            found = {r["doc_id"] for r in decontaminate.leaks(spark.createDataFrame(list(before.values())), spark.read.parquet(f"{MID}/benchmark.parquet")).collect()}
            assert leaking and leaking <= found and set(after) == set(before) - found
        elif name == "secret scans":
            assert set(after) == set(before)
            for i, r in before.items():
                assert not slow_secrets(after[i]["text"]) and after[i]["n_chars"] == len(after[i]["text"])
                if not slow_secrets(r["text"]):
                    assert after[i]["text"] == r["text"]
        else:
            ranks = bpe_replay.Vocabulary.parse(bpe_replay.read_ranks(P.path("byte_bpe_50k.tiktoken"))).ranks
            lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
            import hashlib

            import numpy as np
            for i, r in before.items():
                assert np.frombuffer(after[i]["ids"], "<u4").tolist() == lib.encode_ordinary(r["text"])
                assert after[i]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        texts = after
    assert texts


def test_shared_and_null_ids_lose_no_text_and_keep_no_copy(spark, tmp_path):
    """Half of the ids are doubled over different texts, some are missing: both stages that
    drop rows decide by text."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{MID}/documents.parquet").filter("n_chars > 300").withColumn(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.floor(F.col("doc_id") / 2)).cast("bigint"))
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = {t: slow_fingerprint(t) for _, t in before}
    texts, group = sorted(fps), {t: t for t in fps}
    for x, a in enumerate(texts):
        for b in texts[x + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                old, new = group[b], group[a]
                group = {t: new if g == old else g for t, g in group.items()} if old != new else group
    kept = [(r["doc_id"], r["text"]) for r in C.near_duplicates(spark, docs, MID).collect()]
    assert sorted(group[t] for _, t in kept) == sorted(set(group.values()))  # one row of each group
    for i, t in kept:
        others = [d for d, u in before if group[u] == group[t]]
        assert i == min((d for d in others if d is not None), default=None)
    items = [r["text"] for r in spark.read.parquet(f"{MID}/benchmark.parquet").collect()]
    clean = [(r["doc_id"], r["text"]) for r in C.decontamination(spark, docs, MID).collect()]
    assert not any(i in t for _, t in clean for i in items)
    numbers = docs.select(F.monotonically_increasing_id().alias("doc_id"), "text").checkpoint()
    found = {r["doc_id"] for r in decontaminate.leaks(numbers, spark.read.parquet(f"{MID}/benchmark.parquet")).collect()}
    want = [r["text"] for r in numbers.collect() if r["doc_id"] not in found]
    assert sorted(t for _, t in clean) == sorted(want)


def test_run_over_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{MID}/{t}.parquet")
        (df.filter("false") if t == "documents" else df).write.parquet(str(tmp_path / f"{t}.parquet"))
    out = C.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[0] == "doc_id"


def test_stages_on_odd_rows(spark, odd, tmp_path):
    for name, stage in C.STAGES:
        out = stage(spark, odd, MID)
        assert out.count() <= odd.count()
        if name != C.STAGES[-1][0]:
            assert out.columns == odd.columns
