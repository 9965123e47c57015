"""Chat formatting in budgeted windows, on Spark's own functions.

The turns of a conversation, in order, are cut into turn-aligned spans by the
prefix sums of their tokens. A window shows the leading system turn, some turns
right before its span again (at most ``history`` tokens) and the span; loss
falls on the assistant texts of the span only, so every assistant text counts
once. Prefix sums are built in two levels (blocks of turns, then totals of
blocks), so a long conversation spreads over tasks; the numbered turns are
checkpointed, as four readers share them.

A span starts anew where the prefix sum passes a multiple of half the span's
budget, and around a turn larger than that half; so a span holds no more than
its budget unless one turn alone does. Texts are never cut. The system turn stands
whole in every window, outside this budget: a window has at most SPAN + HISTORY
tokens beside it, so with a system turn of 64 tokens 1,024, with one of 2,500 3,460,
unless one turn alone passes SPAN.

Template: ``### role:``, line feed, text, line feed, ``</turn>``, line feed. In texts a
backslash stands before every ``\\``, ``###`` and ``</turn>``, in roles before ``:`` too;
``read_back`` undoes it.

Defined results: null texts and roles are empty; turns of one number come by
role, then text, null numbers first; repeated rows are turns of their own; a
null conversation id is a conversation; an empty table gives an empty result;
columns of other names are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.blocks import col
from eventide.session import ensure_checkpoint_dir

#: Tokens of a window for the span and the turns shown again, beside the system turn.
SPAN, HISTORY = 768, 192
#: Tokens the template adds to a turn.
TURN_TOKENS = 4
#: Turn numbers of a block of the prefix sums.
BLOCK_TURNS = 256

TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
END = "\n</turn>\n"
_TEXT = r"(\\|###|</turn>)"
_ROLE = r"(\\|###|</turn>|:)"


def escape(c: Column, controls: str = _TEXT) -> Column:
    return F.regexp_replace(c, controls, r"\\$1")


def unescape(c: Column, controls: str = _TEXT) -> Column:
    return F.regexp_replace(c, r"\\" + controls, "$1")


def header(role: Column) -> Column:
    return F.concat(F.lit("### "), escape(role, _ROLE), F.lit(":\n"))


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Turns with ``idx`` (from 0), the prefix sums ``c0`` and ``c1`` of tokens before
    and with the turn, ``big`` and the number of big turns before it, ``nb``."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(col(role_col).cast("string"), F.lit(""))
    t = turns.select(col(conv_col).alias("conv_id"), col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    t = t.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("bigint") + TURN_TOKENS)
    t = t.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))))
    t = t.withColumn("big", (F.col("tokens") > SPAN // 2).cast("bigint"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = t.select("*", (F.row_number().over(inside).cast("bigint") - 1).alias("rank"),
                     F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("w_in"),
                     F.coalesce(F.sum("big").over(before), F.lit(0)).alias("b_in"))
    # the leading system turn stands in every window and weighs nothing in the spans
    lead = F.min_by(F.when(F.col("role") == "system", F.struct("tokens", "big"))
                    .otherwise(F.struct(F.lit(0).cast("bigint").alias("tokens"), F.lit(0).cast("bigint").alias("big"))), "rank")
    blocks = local.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("w"), F.sum("big").alias("b"),
                                                   lead.alias("lead"))
    along = Window.partitionBy("conv_id").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "nwb"],
                         F.first("lead").over(along).alias("lead"))
    t = _with(local, sums).withColumn("idx", F.col("rank") + F.col("n0"))
    system = (F.col("idx") == 0) & (F.col("role") == "system")
    later = F.when(F.col("idx") == 0, F.lit(0).cast("bigint"))
    c0 = later.otherwise(F.col("w_in") + F.col("w0") - F.col("lead.tokens"))
    nb = later.otherwise(F.col("b_in") + F.col("b0") - F.col("lead.big"))
    return t.select("conv_id", "idx", "role", "text", "tokens", system.alias("is_system"), c0.alias("c0"),
                    (c0 + F.when(system, 0).otherwise(F.col("tokens"))).alias("c1"),
                    F.when(system, 0).otherwise(F.col("big")).cast("bigint").alias("big"), nb.alias("nb"))


def _with(t: DataFrame, blocks: DataFrame) -> DataFrame:
    b = blocks.withColumnRenamed("conv_id", "_conv").withColumnRenamed("block", "_block")
    return t.join(b, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))).drop("_conv", "_block")


def windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``(conv_id, window, formatted, loss, n_context, n_tokens)``: window is the
    number of its span's first turn; loss lists (start, end) of the texts that are
    targets, in code points of ``formatted``; the first n_context turns are shown again."""
    t = numbered(turns, conv_col, turn_col, role_col, text_col)
    part = F.when(F.col("big") == 1, F.lit(0)).otherwise(F.floor(F.col("c0") / (SPAN // 2)))
    t = t.withColumn("part", part)
    spans = Window.partitionBy("conv_id", "nb", "big", "part")
    ensure_checkpoint_dir(turns.sparkSession)
    t = t.select("*", F.min("idx").over(spans).alias("window"), (F.max("idx").over(spans) + 1).alias("next"),
                 F.max("c1").over(spans).alias("end")).checkpoint()  # read four times
    fields = ["conv_id", "window", "idx", "context", "role", "text", "tokens"]
    own = t.withColumn("context", F.lit(False)).select(*fields)
    first = (t.filter("idx = window").select(F.col("conv_id").alias("_conv"), F.col("window").alias("_window")))
    again = (t.filter((F.col("end") - F.col("c0") <= HISTORY) & ~F.col("is_system"))
             .join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("next") == F.col("_window")), "left_semi")
             .withColumn("window", F.col("next")).withColumn("context", F.lit(True)).select(*fields))
    system = t.filter("is_system").select("conv_id", "idx", "role", "text", "tokens")
    led = (system.join(first.filter("_window > 0"), F.col("conv_id").eqNullSafe(F.col("_conv")))
           .withColumn("window", F.col("_window")).withColumn("context", F.lit(True)).select(*fields))
    shown = own.union(again).union(led)
    grouped = shown.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("idx", "context", "role", "text"))).alias("turns"),
        F.sum("tokens").alias("n_tokens"), F.count_if("context").alias("n_context"))
    pieces = F.transform("turns", lambda x: F.struct(
        header(x["role"]).alias("head"), escape(x["text"]).alias("body"),
        ((x["role"] == "assistant") & ~x["context"]).alias("target")))
    made = grouped.withColumn("pieces", pieces)

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        return F.struct((end + len(END)).alias("at"), F.when(p["target"], F.concat(
            acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    loss = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return made.select("conv_id", "window", text.alias("formatted"), loss.alias("loss"), "n_context", "n_tokens")


def read_back(made: DataFrame) -> DataFrame:
    """``(conv_id, window, turns, targets)`` from the windows' texts: the turns that
    are not shown again, as (role, text), and the texts under the loss mask."""
    turns = F.filter(F.split("formatted", END), lambda x: x != "")
    whole = r"(?s)^### ((?:[^\\:]|\\.)*+):\n(.*)$"
    new = F.slice(turns, (F.col("n_context") + 1).cast("int"), F.greatest(F.size(turns), F.lit(1)))
    # the system turn and the history stand ahead of the span
    parsed = F.transform(new, lambda x: F.struct(
        unescape(F.regexp_extract(x, whole, 1), _ROLE).alias("role"), unescape(F.regexp_extract(x, whole, 2)).alias("text")))
    targets = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return made.select("conv_id", "window", parsed.alias("turns"), targets.alias("targets"), F.length("formatted").alias("chars"))


def digest(made: DataFrame) -> DataFrame:
    """Per conversation counts and digests of what its windows hold. One row holds a
    conversation here, as its digest demands."""
    back = read_back(made)
    whole = back.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
        F.sum("chars").cast("bigint").alias("formatted_chars"), F.count("*").alias("n_windows"))
    turns, targets = F.flatten(F.transform("w", lambda x: x["turns"])), F.flatten(F.transform("w", lambda x: x["targets"]))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(targets, "")
    return whole.select("conv_id", F.size(turns).cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        "formatted_chars", "n_windows")


#: The same result in SQL, from the turns themselves.
SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS idx,
         len(regexp_extract_all(text, '{TOKEN}')) + {TURN_TOKENS} AS tokens,
         length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g'))
           + 4 + 2 + {len(END)} AS chars
  FROM turns),
weighed AS (SELECT *, idx = 0 AND role = 'system' AS is_system, CASE WHEN idx = 0 AND role = 'system' THEN 0 ELSE tokens END AS weight FROM numbered),
sums AS (
  SELECT *, weight > {SPAN // 2} AS big, sum(weight) OVER w AS c1, sum(weight) OVER w - weight AS c0,
         sum(CASE WHEN weight > {SPAN // 2} THEN 1 ELSE 0 END) OVER w - CASE WHEN weight > {SPAN // 2} THEN 1 ELSE 0 END AS nb
  FROM weighed WINDOW w AS (PARTITION BY conv_id ORDER BY idx ROWS UNBOUNDED PRECEDING)),
parts AS (SELECT *, CASE WHEN big THEN 0 ELSE floor(c0 / {SPAN // 2}) END AS part FROM sums),
spans AS (
  SELECT *, min(idx) OVER s AS win, max(idx) OVER s + 1 AS next, max(c1) OVER s AS last
  FROM parts WINDOW s AS (PARTITION BY conv_id, nb, big, part)),
starts AS (SELECT conv_id, win FROM spans WHERE idx = win),
shown AS (
  SELECT conv_id, chars FROM spans
  UNION ALL SELECT s.conv_id, s.chars FROM spans s JOIN starts n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.next = n.win
    WHERE s.last - s.c0 <= {HISTORY} AND NOT s.is_system
  UNION ALL SELECT s.conv_id, s.chars FROM spans s JOIN starts n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND n.win > 0 WHERE s.is_system),
total AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM shown GROUP BY 1),
wins AS (SELECT conv_id, count(*) AS n_windows FROM starts GROUP BY 1),
said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx) AS whole,
         coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = 'assistant'), '') AS loss
  FROM numbered GROUP BY 1)
SELECT s.conv_id, s.n_turns, sha256(s.whole) AS turns_sha256, length(s.loss)::BIGINT AS loss_chars, sha256(s.loss) AS loss_sha256,
       t.formatted_chars, w.n_windows
FROM said s JOIN total t ON s.conv_id IS NOT DISTINCT FROM t.conv_id JOIN wins w ON s.conv_id IS NOT DISTINCT FROM w.conv_id
"""
