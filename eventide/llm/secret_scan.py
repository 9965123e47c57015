"""Secret scans: patterns, and entropy of sliding windows over candidate strings.

All on Spark's own functions. Three patterns give the base spans. The method
adds spans: a window of WINDOW characters slides over every candidate string (a
run of characters that keys are made of, with a digit in it); adding one
character and dropping one changes the sum of c log2 c over the window's
character counts by the terms of those two characters only, and the Shannon
entropy follows from the sum. A window is hot if its entropy reaches the
threshold of its character class (hex, one case with digits, mixed); the span
of a candidate with a hot window is the whole candidate.
Candidates that match an allow-list pattern are suppressed; base spans stay. A word
of documentation ("example") suppresses only the segment between separators that
holds it: what stands before or behind it is judged without it, so a key that is
joined to such a word is found. A span that lies within a base span is not added again.

Defined results: a null text is the empty text, without spans; repeated rows
get equal spans; an empty table gives an empty result; columns of any other
name may stand beside id and text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import col
from eventide.llm.spans import count_of, in_order, matches, named, replaced, spans_of

#: Fixed values of the base patterns.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "entropy"]
MARKS = ["<SECRET>", "<ACCESS_KEY>", "<HEX_KEY>", "<KEY>"]

#: Characters of a window.
WINDOW = 20
#: Runs of characters that keys are made of, with a digit, as long as a window at least.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{%d,}+" % WINDOW
#: Least entropy in bits by class: hex digits only; one case and digits; both cases and digits.
#: The 1 % quantiles of windows of random characters (2.90, 3.41, 3.65).
THRESHOLDS = (2.9, 3.4, 3.64)
#: Digits that a hot window of one case has at least, here; of 20 random characters 5 % have under three.
ONE_CASE_DIGITS = 1
#: Candidates that are no secrets: UUIDs, numbers, words and slugs, the form of documentation keys, paths.
ALLOW = (r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[0-9+/_-]+", r"[A-Za-z]*([-_/+][A-Za-z]+)*[-_/+]?[0-9]{0,4}",
         r"[A-Za-z0-9+/]{30}EXAMPLEKEY", r"/?([a-z0-9_-]{1,12}/)+[a-z0-9_-]{0,12}")
#: A segment between separators that holds one of these is documentation.
ALLOW_SEGMENT = "EXAMPLE|example|0123456789|abcdefgh"
SEPARATORS = "-_/+"


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, in order."""
    # runs that are too short need not be matched one by one: a maximal run
    # matches or does not, whatever its beginning
    return in_order(
        spans_of(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6,
                 hint=r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]"),
        spans_of(text, r"AKIA[A-Z0-9]{16,}+", 1, lambda m: F.length(m) >= 20),
        spans_of(text, r"[0-9a-f]{24,}+", 2, lambda m: F.length(m) >= 24))


def hot_part(run: Column, window: int = WINDOW, thresholds: tuple[float, float, float] = THRESHOLDS,
             one_case_digits: int = ONE_CASE_DIGITS) -> Column:
    """``struct<first, last>`` (from 0, last exclusive) of the hot windows of an
    ASCII string; first is null if none is hot."""
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c))
    # what each step adds to the window and drops from it (-1: nothing yet)
    moves = F.transform(F.arrays_zip(codes.alias("new"), F.concat(F.array_repeat(F.lit(-1), window), codes).alias("old")),
                        lambda m, k: F.struct(m["new"].alias("new"), m["old"].alias("old"), (k + 1).alias("i")))
    moves = F.filter(moves, lambda m: m["new"].isNotNull())

    def term(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def is_digit(c: Column) -> Column:
        return c.between(48, 57).cast("int")

    def is_lower(c: Column) -> Column:
        return c.between(97, 122).cast("int")

    def is_upper(c: Column) -> Column:
        return c.between(65, 90).cast("int")

    def is_hex(c: Column) -> Column:
        return (c.between(48, 57) | c.between(97, 102) | c.between(65, 70)).cast("int")

    def step(acc: Column, move: Column) -> Column:
        new, old, i = move["new"], move["old"], move["i"]
        c_new = F.get(acc["n"], new)
        same = new == old  # the window neither gains nor loses
        c_old = F.coalesce(F.get(acc["n"], F.greatest(old, F.lit(0))), F.lit(0))
        total = (acc["s"] + F.when(same, 0.0).otherwise(term(c_new + 1) - term(c_new))
                 + F.when(same | (old < 0), 0.0).otherwise(term(c_old - 1) - term(c_old)))
        n = F.transform(acc["n"], lambda c, k: c + (k == new).cast("int") - (k == old).cast("int"))
        digit = acc["digit"] + is_digit(new) - is_digit(old)
        lower = acc["lower"] + is_lower(new) - is_lower(old)
        upper = acc["upper"] + is_upper(new) - is_upper(old)
        hexed = acc["hexed"] + is_hex(new) - is_hex(old)
        entropy = F.lit(math.log2(window)) - total / F.lit(float(window))
        kind_hot = (F.when((hexed == window) & ((lower == 0) | (upper == 0)),
                           (entropy >= thresholds[0]) & (digit >= 2) & (digit <= window - 2))
                    .when((lower == 0) | (upper == 0), (entropy >= thresholds[1]) & (digit >= one_case_digits) & (lower + upper >= 3))
                    .otherwise((entropy >= thresholds[2]) & (digit >= 1)))
        hot = (i >= window) & kind_hot
        return F.struct(n.alias("n"), total.alias("s"), digit.alias("digit"), lower.alias("lower"), upper.alias("upper"),
                        hexed.alias("hexed"),
                        F.when(hot & acc["first"].isNull(), i - window).otherwise(acc["first"]).alias("first"),
                        F.when(hot, i).otherwise(acc["last"]).alias("last"))

    zero = F.lit(0)
    start = F.struct(F.array_repeat(zero, 128).alias("n"), F.lit(0.0).alias("s"), zero.alias("digit"), zero.alias("lower"),
                     zero.alias("upper"), zero.alias("hexed"), F.lit(None).cast("int").alias("first"),
                     F.lit(None).cast("int").alias("last"))
    done = F.aggregate(moves, start, step)
    return F.struct(done["first"].alias("first"), done["last"].alias("last"))


def judged_parts(run: Column) -> Column:
    """What of a candidate is judged: all of it, or what is left around segments of documentation."""
    segments = F.split(run, f"(?<=[{SEPARATORS}])")
    left = F.array_join(F.transform(segments, lambda s: F.when(s.rlike(ALLOW_SEGMENT), F.lit("\n")).otherwise(s)), "")
    around = F.filter(F.split(left, "\n"), lambda s: F.length(s) >= WINDOW)
    return F.when(run.rlike(ALLOW_SEGMENT), around).otherwise(F.array(run))


def entropy_spans(text: Column, base: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """Spans of candidates with a hot window, outside the base spans, kind 3."""
    listed = "|".join(f"(?:{a})" for a in allow)
    runs = matches(text, CANDIDATE, hint="[0-9]")
    if allow:
        runs = F.filter(runs, lambda m: ~m["value"].rlike(f"^(?:{listed})$"))
    hot = F.filter(runs, lambda m: F.exists(judged_parts(m["value"]) if allow else F.array(m["value"]),
                                            lambda part: hot_part(part)["first"].isNotNull()))
    found = F.transform(hot, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end")))
    return F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))


def scan(docs: DataFrame, text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Structs ``d`` (the columns of ``docs``), and arrays ``base`` and ``spans`` of
    spans; spans holds the base ones and those of the method."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    held = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d"), text.alias("t"))
    held = held.withColumn("base", base_spans(F.col("t")))
    added = entropy_spans(F.col("t"), F.col("base"), allow)
    return held.withColumn("added", added).select("d", "t", "base", in_order(F.col("base"), F.col("added")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by a mark; a count of code points, where
    there is one, follows. A null text stays null."""
    found = scan(docs, text_col)
    clean = F.when(F.col("d")[text_col].isNull(), F.col("d")[text_col]).otherwise(
        replaced(F.col("t"), F.col("spans"), MARKS))
    made = found.select("d", clean.alias("clean"))
    kinds = dict(docs.dtypes)
    return made.select(*[F.col("clean").alias(c) if c == text_col
                         else F.length("clean").cast(kinds[c]).alias(c) if c == length_col else F.col("d")[c].alias(c)
                         for c in docs.columns])
