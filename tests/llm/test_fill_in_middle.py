"""Fill-in-middle: against a plain version, round trips, and the sentinel reader."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from eventide.llm import fill_in_middle as fim
from llm_fixtures import documents, none, odd, odd_rows, real_texts  # noqa: F401

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_version(doc_id, text, rate=50, spm=80):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, sha(text), sha(text)), text
    if h4 % 100 < spm:
        form, out = "spm", f"<S>{s}<P>{p}<M>{m}"
    else:
        form, out = "psm", f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text)), out


def key(row):
    return tuple((v is not None, v) for v in row)


def both(rows, got, **options):
    want = sorted((plain_version(i, t, **options)[0] for i, t in rows), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want


def test_documents(spark, documents, real_texts):
    both(real_texts, fim.digests(documents.repartition(4)).collect())


@pytest.mark.parametrize("rate,spm", [(100, 80), (100, 0), (0, 80)])
def test_odd_rows(odd, rate, spm):
    """Null ids and texts, empty, very long, repeated rows, clashing names."""
    both([r[:2] for r in odd_rows()], fim.digests(odd, rate=rate, spm=spm).collect(), rate=rate, spm=spm)


def test_empty_table(none):
    assert fim.digests(none).collect() == [] and fim.transform(none).collect() == []


def test_texts_and_restoration(spark):
    rows = [(k, t) for k, t in enumerate(["<S", "a <P", "x<M y", "one <P> two", "< <S <P <M", " \n", "a  b\n", "é 中 😀"] * 9)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    made = fim.transform(docs, rate=100).collect()
    assert sorted((r.doc_id, r.output) for r in made) == [(i, plain_version(i, t, 100)[1]) for i, t in rows]
    back = fim.restore(fim.transform(docs, rate=100)).collect()
    assert sorted(map(tuple, back)) == rows
    both(rows, fim.digests(docs, rate=100).collect(), rate=100)


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_sentinels_across_pieces(size):
    """The reader finds sentinels however the output is cut."""
    for form, parts in (("psm", (b"pre<", b"su<Sf<", b"<P mid")), ("spm", (b"", b"s<S", b""))):
        prefix, suffix, middle = parts
        text = {fim.PREFIX: prefix, fim.SUFFIX: suffix, fim.MIDDLE: middle}
        out = b"".join(s + text[s] for s in fim.ORDERS[form])
        reader = fim._Splitter(form)
        runs = [r for k in range(0, len(out), size) for r in reader.feed(out[k:k + size])] + list(reader.end())
        assert b"".join(c for _, c in sorted(runs)) == prefix + middle + suffix


def test_one_exchange(documents):
    plan = fim.digests(documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 3


def test_plain_texts_are_sorted_and_restored_too(spark, monkeypatch):
    """Both digests of a plain text come from its pieces behind the exchange."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "")], "doc_id int, text string")
    before = fim.in_order
    marked = F.concat("chunk", F.encode(F.lit("!"), "UTF-8"))
    monkeypatch.setattr(fim, "in_order", lambda found: before(found.withColumn("chunk", marked)))
    got = {r.doc_id: (r.form, r.output_sha256, r.restored_sha256) for r in fim.digests(docs, rate=0).collect()}
    assert got == {1: ("plain", sha("a b c!"), sha("a b c!")), 2: ("plain", sha("!"), sha("!"))}
