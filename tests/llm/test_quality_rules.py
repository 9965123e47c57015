import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventide.llm import quality_rules as Q
from eventide.llm.queries import op4_quality_rules
from llm_fixtures import labels, none, odd, real_texts, sf  # noqa: F401


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    found = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if found[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t#|é中\x1c\x85\xa0😀"), max_size=60))
def test_counts_match_brute_force(text):
    assert Q.text_counts(text.encode())[:5] == slow(text)


def test_counts_on_real_texts(real_texts):
    for _, text in real_texts:
        assert Q.text_counts(text.encode())[:5] == slow(text)


def test_repeats_with_more_distinct_words_than_fit_a_product():
    ids = np.array([5, 6, 7, 1, 5, 6, 7, 2])
    assert Q.repeated_window_words(ids, 8) == Q.repeated_window_words(ids, 3_000_000) == 6


def test_covering_learns_a_conjunction_and_keeps_order():
    r = np.random.default_rng(0)
    x = {"p": r.random(3000), "q": r.random(3000), "noise": r.random(3000)}
    bad = (x["p"] > 0.8) & (x["q"] < 0.5) | (x["q"] > 0.95)
    rules = Q.learn_rules(x, bad, np.arange(3000) % 3 == 0)
    hit = np.zeros(3000, bool)
    for rule in rules:
        hit |= rule.holds(x, 3000)
    assert (hit == bad).mean() > 0.98
    assert len(rules) >= 2 and not any(c.statistic == "noise" and len(rule.conditions) == 1 for rule in rules for c in rule.conditions)


def test_no_rules_from_labels_of_one_kind():
    x = {"p": np.arange(10.0)}
    assert Q.learn_rules(x, np.zeros(10, bool), np.arange(10) % 3 == 0) == []


def test_verdict_is_one_conditional_expression(spark):
    rules = [Q.Rule((Q.Condition("v", True, 3.0), Q.Condition("v", False, 5.0))), Q.Rule((Q.Condition("v", True, 9.0),))]
    df = spark.range(12).select(F.col("id").cast("double").alias("v"))
    kept = [r["k"] for r in df.select("v", Q.verdict(rules, {"v": F.col("v")}).alias("k")).orderBy("v").collect()]
    assert kept == [not (3 <= v <= 5 or v >= 9) for v in range(12)]


def test_held_out_labels_agree(spark, sf):
    out = op4_quality_rules(spark, "/root/testdata/sf0.01")
    seen = out.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").toPandas()
    passed = seen[~seen.base_failed]
    assert (passed.kept == (passed.quality == 1)).mean() > 0.97
    assert not seen[seen.base_failed].kept.any()


def test_odd_rows(spark, odd, none, labels):
    kept = Q.keep(odd, labels)
    assert kept.schema == odd.schema
    rows = [r for r in Q.judge(odd, []).select("d.doc_id", "q.n_words", "q.kept").collect()]
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and not by[1]["kept"]
    assert by[6]["kept"] == by[7]["kept"] is True and by[6]["n_words"] == 60_000
    assert sum(r["doc_id"] == 7 and r["kept"] for r in rows) == 2
    assert Q.keep(none, labels).count() == 0
    assert Q.keep(odd, labels.filter("false")).count() == 3  # no rules: the base rule decides


@pytest.mark.parametrize("bad_labels", [[(6, None), (7, 7)], [(6, 0), (6, 1), (None, 1)]])
def test_null_and_strange_labels(spark, odd, bad_labels):
    assert Q.fit(odd, spark.createDataFrame(bad_labels, "doc_id bigint, quality int")) == []
