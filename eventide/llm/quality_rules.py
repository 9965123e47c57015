"""Quality rules: a decision list learned by sequential covering.

Statistics of every whole text come from one Arrow function (one pass over the
words of a text); ratios of them are Spark expressions. From labelled rows an
ordered list of threshold conjunctions is grown and pruned (grow by gain in
information, prune on rows held back), and the list becomes one ordered Spark
conditional expression, so applying it costs no Python.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; ratios of empty texts are 0; repeated rows get equal verdicts; an
empty table gives an empty result; columns other than id and text pass through
untouched, also when they bear the names of statistics. Without labels of both
kinds the list is empty and the base rule alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from eventide.llm.blocks import SPACE, col, labelled_sample, small_batches, utf8

#: Counts of a text, in the order the Arrow function returns them.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_digits", "n_marks", "n_distinct", "n_ended_lines", "n_chars")

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = b"!?"
#: Bytes of UTF-8 that continue a code point.
CONTINUED = bytes(range(0x80, 0xC0))

#: Labelled rows the list is learned from, at most.
LEARN_ROWS = 20_000


def text_counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text in UTF-8."""
    words = text.split()
    n = len(words)
    codes = len(text.translate(None, CONTINUED))
    blank = len(text) - len(text.translate(None, SPACE))
    lines = text.split(b"\n")
    full = [line for line in lines if line.strip()]
    order = {w: i for i, w in enumerate(dict.fromkeys(words))}
    repeats = 0
    if n >= 4:
        ids = np.fromiter(map(order.__getitem__, words), np.int64, n)
        repeats = repeated_window_words(ids, len(order))
    return (n, codes - blank, _amount(text, SYMBOLS), len(full) - len(set(full)), repeats, len(full),
            _amount(text, UPPER), _amount(text, DIGITS), _amount(text, MARKS), len(order),
            sum(line.rstrip().endswith((b".", b"!", b"?")) for line in full), codes)


def _amount(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def repeated_window_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window found at least twice."""
    pair = ids[:-2] * distinct + ids[1:-1]
    if distinct > 2_000_000:  # the product of three would pass 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * distinct + ids[2:]
    ranked = np.sort(key)
    if not (twice := ranked[1:][ranked[1:] == ranked[:-1]]).size:
        return 0
    at = np.isin(key, twice)
    hit = np.zeros(len(ids), bool)
    for j in range(3):
        hit[j:len(at) + j] |= at
    return int(hit.sum())


_STRUCT = pa.struct([(c, pa.int64()) for c in COUNTS])


def _counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = np.array([text_counts(t) for t in utf8(texts)], np.int64).reshape(-1, len(COUNTS))
        yield pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))],
                                         fields=list(_STRUCT))


def counts(text: Column) -> Column:
    """COUNTS of a text column as a struct; computed once, whatever stands above."""
    kind = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    return arrow_udf(_counts, kind).asNondeterministic()(text)


def ratios(s: Column) -> dict[str, Column]:
    """Statistics the list may test, as Spark expressions over COUNTS."""
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(s[a].cast("double"), s[b].cast("double")), F.lit(0.0))
    return {
        "words": s["n_words"].cast("double"),
        "mean_word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_line_share": share("n_dup_lines", "n_lines"),
        "repeated_word_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
        "distinct_word_share": share("n_distinct", "n_words"),
        "ended_line_share": share("n_ended_lines", "n_lines"),
        "words_per_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    """``statistic >= threshold`` or ``statistic <= threshold``."""
    statistic: str
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x >= self.threshold if self.at_least else x <= self.threshold

    def expression(self, stats: dict[str, Column]) -> Column:
        c = stats[self.statistic]
        return c >= self.threshold if self.at_least else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction; a text for which it holds is rejected."""
    conditions: tuple[Condition, ...]

    def holds(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        out = np.ones(n, bool)
        for c in self.conditions:
            out &= c.holds(x[c.statistic])
        return out

    def expression(self, stats: dict[str, Column]) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.expression(stats)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], longest: int) -> Rule:
    """Add the condition of the largest information gain until only bad rows are covered."""
    covered = np.ones(len(bad), bool)
    rule: list[Condition] = []
    while len(rule) < longest and covered.any() and not bad[covered].all():
        p0, n0 = int(bad[covered].sum()), int(covered.sum())
        if not p0:
            break
        best, gain = None, 1e-9
        y = bad[covered]
        for name, values in cuts.items():
            v = x[name][covered]
            order = np.argsort(v, kind="stable")
            hits, ranked = np.concatenate(([0], np.cumsum(y[order]))), v[order]
            below = np.searchsorted(ranked, values, side="right")  # rows <= cut
            above = np.searchsorted(ranked, values, side="left")   # rows < cut
            for at_least, p, n in ((False, hits[below], below), (True, p0 - hits[above], n0 - above)):
                ok = (p > 0) & (n < n0)
                g = np.where(ok, p * (np.log2(np.maximum(p, 1) / np.maximum(n, 1)) - np.log2(p0 / n0)), 0)
                if len(g) and g.max() > gain:
                    gain, best = g.max(), Condition(name, at_least, float(values[int(g.argmax())]))
        if best is None:
            break
        rule.append(best)
        covered &= best.holds(x[best.statistic])
    return Rule(tuple(rule))


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    hit = rule.holds(x, len(bad))
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, hold_back: np.ndarray, max_rules: int = 16,
                longest: int = 4, cuts_per_statistic: int = 128, min_precision: float = 0.8) -> list[Rule]:
    """Sequential covering: rules in the order found, each grown on the rows not
    held back, pruned on the others, and taken while it is precise on both."""
    left, rules = np.ones(len(bad), bool), []
    for _ in range(max_rules):
        grow, prune = left & ~hold_back, left & hold_back
        if not bad[grow].any():
            break
        part = {k: v[grow] for k, v in x.items()}
        cuts = {k: np.unique(np.concatenate((np.quantile(v, np.linspace(0, 1, cuts_per_statistic)),
                                             np.quantile(v[bad[grow]], np.linspace(0, 1, 32)))))
                for k, v in part.items()}
        rule = _grow(part, bad[grow], cuts, longest)
        back = {k: v[prune] for k, v in x.items()}
        options = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
        if not options:
            break
        rule = max(options, key=lambda r: (_worth(r, back, bad[prune]), -len(r.conditions)))
        hit = rule.holds(x, len(bad)) & left
        if (hit & bad).sum() < max(2, min_precision * hit.sum()) or _worth(rule, back, bad[prune]) < 2 * min_precision - 1:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule], stats: dict[str, Column]) -> Column:
    """The ordered conditional expression: False at the first rule that holds, else True."""
    out = None
    for rule in rules:
        out = (F.when if out is None else out.when)(rule.expression(stats), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed(s: Column) -> Column:
    """Too short, or over half of the words lie in repeated windows."""
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def fit(docs: DataFrame, labels: DataFrame, bound: int = LEARN_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> list[Rule]:
    """Learn the list from at most ``bound`` labelled rows that pass the base
    rule; a third of them, by a hash of the id, is held back for pruning."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label_col, bound, None, id_col, text_col)
    s = sample.select("doc_id", "label", counts(F.col("text")).alias("s"))
    stats = ratios(F.col("s"))
    rows = (s.filter(~base_failed(F.col("s")))
            .select((F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).alias("back"), "label",
                    *[c.alias(k) for k, c in stats.items()]).toPandas())
    rows = rows.sort_values(list(rows.columns), kind="stable")  # not the order of arrival
    return learn_rules({k: rows[k].to_numpy() for k in stats}, rows["label"].to_numpy() == 0,
                       rows["back"].to_numpy(bool))


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """Two structs for each row: ``d`` with all columns of ``docs``, and ``q``
    with COUNTS, ``base_failed`` and ``kept``."""
    small_batches(docs.sparkSession)
    held = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d"),
                       counts(col(text_col).cast("string")).alias("s"))
    s = F.col("s")
    return held.select("d", F.struct(
        *[s[c].alias(c) for c in COUNTS], base_failed(s).alias("base_failed"),
        (~base_failed(s) & verdict(rules, ratios(s))).alias("kept")).alias("q"))


def keep(docs: DataFrame, labels: DataFrame, bound: int = LEARN_ROWS) -> DataFrame:
    """The documents that the learned list keeps, with their own columns."""
    return judge(docs, fit(docs, labels, bound)).filter("q.kept").select("d.*")
