"""Spans of pattern matches in texts, on Spark's own functions.

A span is ``struct(start, kind, end)``: code points from 0, end exclusive; kind
is a number. Positions are running sums over the text between matches (split)
and the matches themselves (regexp_extract_all), which scan alike. Patterns
must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

KIND = "array<struct<start:bigint,kind:int,end:bigint>>"
#: Matches whose spans are gathered before they join the longer list.
CHUNK = 256


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` reads it."""
    return F.transform(F.array(value), f)[0]


def running(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The state after each item, an array of ``kind``. States are gathered in chunks that are
    joined once, so the time follows the number of items."""
    none = F.array().cast(f"array<{kind}>")

    def add(acc: Column, x: Column) -> Column:
        return bind(step(acc["at"], x), lambda v: F.struct(v.alias("at"), F.concat(acc["out"], F.array(v)).alias("out")))

    def along(b: Column) -> Column:
        def chunk(acc: Column, first: Column) -> Column:
            part = F.aggregate(F.slice(b, first, F.lit(CHUNK)), F.struct(acc["at"].alias("at"), none.alias("out")), add)
            return bind(part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

        start = F.struct(zero.cast(kind).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        chunks = F.when(F.size(b) > 0, F.sequence(F.lit(1), F.size(b), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.aggregate(chunks, start, chunk)["out"])

    return bind(items, along)


def matches(text: Column, pattern: str, hint: str | None = None) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost non-overlapping matches.
    ``hint`` is a quicker pattern that every text with a match contains."""
    kind = "array<struct<start:bigint,end:bigint,value:string>>"
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))

    def size(x: Column) -> Column:  # the last gap has no match behind it
        return F.length(x["gap"]) + F.coalesce(F.length(x["value"]), F.lit(0))

    def placed(b: Column) -> Column:
        ends = running(b, F.lit(0), lambda at, x: at + size(x), "bigint")
        every = bind(ends, lambda e: F.transform(b, lambda x, i: F.struct(
            (F.get(e, i) - F.length(x["value"])).alias("start"), F.get(e, i).alias("end"), x["value"].alias("value"))))
        return F.filter(every, lambda m: m["value"].isNotNull())

    there = text.rlike(pattern) if hint is None else text.rlike(hint) & text.rlike(pattern)
    return F.when(there, bind(both, placed)).otherwise(F.array().cast(kind))


def spans_of(text: Column, pattern: str, kind: int, fits: Callable[[Column], Column], hint: str | None = None) -> Column:
    """Spans of the matches for whose text ``fits`` holds; others are dropped."""
    good = F.filter(matches(text, pattern, hint), lambda m: fits(m["value"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def in_order(*lists: Column) -> Column:
    """All spans by start, then kind, then end."""
    return F.array_sort(F.concat(*lists))


def named(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    table = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.element_at(table, s["kind"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def replaced(text: Column, spans: Column, marks: list[str]) -> Column:
    """``text`` with each span replaced by the mark of its kind; of spans that
    overlap, the first gives the mark and the rest of the others goes with it."""
    table = F.array(*[F.lit(m) for m in marks])

    def add(acc: Column, s: Column) -> Column:
        inside = s["end"] <= acc["at"]
        covered = s["start"] < acc["at"]
        before = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        piece = F.when(covered, F.array().cast("array<string>")).otherwise(
            F.array(before, F.element_at(table, s["kind"] + 1)))
        return F.struct(F.when(inside, acc["at"]).otherwise(s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    made = F.aggregate(spans, start, add)
    rest = F.substring(text, (made["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(made["out"], ""), rest))
