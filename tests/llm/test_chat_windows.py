import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from eventide.llm import chat_windows as C
from eventide.llm.queries import ORACLES, op5_chat_windows
from llm_fixtures import sf  # noqa: F401


def _frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window int, idx string, pieces int")


def _odd_conversations():
    r = random.Random(2)
    bits = ["\\", "###", "</turn>", "\n", " ", "### user:", "ok", "é😀", "\n</turn>\n", "$1", ":"]
    rows = []
    for c in range(40):
        n = r.randint(1, 30)
        for k in range(n):
            role = "system" if k == 0 and c % 3 == 0 else r.choice(["user", "assistant", "assistant", "a:b\\", ""])
            text = "".join(r.choice(bits) for _ in range(r.randint(0, 6))) + " word" * r.choice([0, 3, 50, 300, 900])
            rows.append((c, k, role, text, 1, "x", 2))
    rows += [(100, 0, "system", "alone", 1, "x", 2), (101, None, None, None, 1, "x", 2), (101, 3, "assistant", None, 1, "x", 2),
             (None, 0, "user", "hi", 1, "x", 2), (None, 1, "assistant", "there", 1, "x", 2),
             (102, 5, "user", "tie b", 1, "x", 2), (102, 5, "assistant", "tie a", 1, "x", 2), (102, 5, "assistant", "tie a", 1, "x", 2),
             (103, 0, "assistant", "long " * 40_000, 1, "x", 2)]
    rows += [(104, k, "user" if k % 2 else "assistant", f"t{k} " + "w " * 30, 1, "x", 2) for k in range(1500)]
    return rows


def _expected(rows):
    conv = {}
    for c, turn, role, text, *_ in rows:
        conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in conv.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_windows_hold_every_turn_once(spark):
    rows = _odd_conversations()
    made = C.windows(_frame(spark, rows).repartition(5)).cache()
    got = {r["conv_id"]: r for r in C.digest(made).collect()}
    want = _expected(rows)
    assert set(got) == set(want)
    for c, (n, said, chars, loss) in want.items():
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (n, said, chars, loss), c
    shown = made.collect()
    assert got[104]["n_windows"] > 60
    by = {}
    for w in shown:
        by.setdefault(w["conv_id"], []).append(w)
        assert all(w["formatted"][b["end"]:].startswith(C.END) for b in w["loss"])
    for w in by[104]:  # no turn is larger than half a span here
        assert w["n_tokens"] <= C.SPAN + C.HISTORY
        assert w["n_context"] > 0 or w["window"] == 0
    for c, ws in by.items():  # the system turn leads every window
        if any(x[0] == c and x[2] == "system" and x[1] == 0 for x in rows):
            assert all(w["formatted"].startswith("### system:\n") for w in ws)


def test_escape_is_reversible(spark):
    r = random.Random(4)
    texts = ["".join(r.choice(["\\", "#", "###", "</turn>", ":", "\n", " ", "a", "$1", "</turn"]) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    raw = C.escape(F.col("t"))
    for t, a, b, x in df.select("t", C.unescape(raw), C.unescape(C.escape(F.col("t"), C._ROLE), C._ROLE), raw).collect():
        assert t == a == b and C.END not in x + "x"


def test_sql_gives_the_same(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    rel = con.sql(ORACLES["op5_chat_windows"])
    df = op5_chat_windows(spark, sf).select(*rel.columns)
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_sql_on_odd_conversations(spark):
    import pandas as pd
    rows = [r for r in _odd_conversations() if r[0] is not None]
    con = duckdb.connect()
    t = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text", "a", "b", "c"])
    t["turn"] = t["turn"].astype("Int64")
    con.register("given", t)
    con.execute("create table conversations as select conv_id, turn, role, text from given")
    rel = con.sql(ORACLES["op5_chat_windows"])
    want = {r[0]: r for r in rel.fetchall() if r[0] != -7}
    df = C.digest(C.windows(_frame(spark, rows))).select(*rel.columns)
    assert {r[0]: tuple(r) for r in df.collect()} == want


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "", 1, "x", 2)]])
def test_tiny_tables(spark, rows):
    assert C.digest(C.windows(_frame(spark, rows))).count() == len(rows)


def test_windows_hold_their_budget_beside_the_system_turn(spark):
    r = random.Random(9)
    rows = []
    for conv, system in enumerate((0, 10, 400, 3000)):
        rows += [(conv, 0, "system", "s " * system)] if system else []
        rows += [(conv, k, "user" if k % 2 else "assistant", "w " * r.choice((3, 40, 200, 380, 700, 1500))) for k in range(1, 60)]
    made = C.windows(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    tokens = {conv: next((len(t.split()) + C.TURN_TOKENS for c, k, role, t in rows if c == conv and role == "system"), 0) for conv in range(4)}
    over = [m["n_tokens"] - tokens[m["conv_id"]] for m in made if m["n_tokens"] - tokens[m["conv_id"]] > C.SPAN + C.HISTORY]
    # beyond the budget only with one turn that is alone beyond the span's
    assert made and all(n - C.HISTORY <= 1500 + C.TURN_TOKENS and n >= 1500 for n in over)
