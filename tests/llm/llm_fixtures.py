"""Fixtures of the operator tests, imported by name (a second conftest would hide the first)."""
import os
import random

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def real_texts():
    """(doc_id, text) of the smallest table, with some texts of check-like size."""
    import duckdb
    return duckdb.sql(f"select doc_id, text from read_parquet('{SMALL}/documents.parquet') order by doc_id").fetchall()


#: Columns whose names the operators use inside.
CLASH = "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, s int, d int, t string, " \
        "base string, spans string, fp string, rep string, rank int, block int, cell int, ends string, `a.b` int, _key int"


def odd_rows():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9)))
    long = " ".join(word() for _ in range(60_000))
    rest = ("x", 1, 2, "y", "z", "w", "v", "u", 3, 4, 5, "q", 6, 7)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, long), (7, long), (7, long),
             (None, "no id here at all"), (None, None), (8, "Grüße 中文 😀 \x00 \x85 ok"), (9, "z" * 300_000)]
    return [(i, t, "en", "src", None if t is None else len(t), *rest) for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, clashing names."""
    return spark.createDataFrame(odd_rows(), CLASH).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], CLASH)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(os.path.join(SMALL, "labels.parquet"))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join(SMALL, "documents.parquet"))
