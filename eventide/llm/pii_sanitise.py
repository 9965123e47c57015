"""PII by information-theoretic sanitisation.

All on Spark's own functions. Four patterns find the entities to protect
(e-mail, IP, card and phone numbers); these are the base spans. The corpus then
tells which terms of a document give an entity in it away: with document counts
over the whole corpus, a term t in the documents of an entity c discloses

    PMI(c; t) / IC(c) = log2(N df(c,t) / (df(c) df(t))) / log2(N / df(c))

of it: 1 if t alone tells c, about 0 if t says nothing. Terms whose share
reaches GENERALISE are generalised (to a mark), from REMOVE on removed, at every
place in the documents that hold c; df(c,t) must reach SUPPORT documents, as one
document is no evidence. Term spans join the base spans.

Terms are all words (runs of letters or digits, lower-cased one by one) of the whole
text that lie outside base spans.

Documents are the distinct pairs of id and text, in every count: the terms of a
repeated row are counted once. Counts are keyed by 64-bit hashes. Entities that
occur in the very same documents share a class, and so do terms, by a digest of
their documents; a document pairs its classes, not its entities and terms, so a
page of thousands of addresses that stand together is one class. Entities and
terms of under SUPPORT documents, and terms too frequent to disclose any entity
(df(t) > df(c)^s N^(1-s) for the share s and the most frequent c), are dropped
before anything is paired. Joins on a term or a class are salted, so neither a
frequent entity nor a frequent term fills one task.

Defined results: a null text is the empty text; repeated rows (equal id and
text) count as one document and get equal spans; an empty table gives an empty
result; an entity that every document holds has nothing left to disclose;
columns of any other name may stand beside id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import col
from eventide.llm.spans import KIND, bind, count_of, in_order, matches, named, replaced, running, spans_of
from eventide.session import ensure_checkpoint_dir

KINDS = ["email", "ip", "card", "phone", "term", "term"]
MARKS = ["<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "<TERM>", ""]
_GENERALISED, _REMOVED = 4, 5

#: The base patterns. Possessive repeats and the looks behind keep them from
#: trying again inside a run; \\G lets a match begin where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

SUPPORT = 2
GENERALISE, REMOVE = 0.7, 0.9
#: Ways the documents of an entity, a term or a class are split in joins.
SALTS = 32
#: Base spans of a text up to which each word is compared with each of them.
FEW_SPANS = 16
WORDS = r"[\p{L}\p{N}]++"


def _ip_fits(m: Column) -> Column:
    part = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, k: F.struct(c.cast("int").alias("v"), (k % 2).alias("odd")))
    doubled = F.transform(values, lambda x: F.when(x["odd"] == 0, x["v"]).when(x["v"] < 5, x["v"] * 2).otherwise(x["v"] * 2 - 9))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the four patterns, in order."""
    return in_order(
        spans_of(text, EMAIL, 0, lambda m: F.lit(True), hint="@"),
        spans_of(text, IP, 1, _ip_fits, hint=r"[0-9]\.[0-9]"),
        spans_of(text, CARD, 2, lambda m: F.length(_digits(m)).between(12, 19) & luhn(_digits(m)), hint="[0-9][\\x20-]?[0-9]"),
        spans_of(text, PHONE, 3, lambda m: F.length(_digits(m)).between(9, 15), hint=r"\+[0-9]"))


def entities_of(text: Column, spans: Column) -> Column:
    """The distinct entities (hashes of kind and value) of base spans."""
    def one(s: Column) -> Column:
        value = F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        plain = F.when(s["kind"] >= 2, F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value))
        return F.xxhash64(s["kind"], plain)

    return F.array_distinct(F.transform(spans, one))


def outside(words: Column, spans: Column) -> Column:
    """The words that overlap no span. Of many spans the greatest end before a word and the
    smallest start behind it tell, found by one pass each way over words and spans in order."""
    def compared(w: Column) -> Column:
        return ~F.exists(spans, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))

    def swept(merged: Column) -> Column:
        far = F.lit(1 << 60)
        before = running(merged, F.lit(-1), lambda at, x: F.when(x["is_word"] == 0, F.greatest(at, x["end"])).otherwise(at), "bigint")
        behind = running(F.reverse(merged), far, lambda at, x: F.when(x["is_word"] == 0, F.least(at, x["start"])).otherwise(at), "bigint")
        every = bind(before, lambda up: bind(F.reverse(behind), lambda down: F.transform(merged, lambda x, i: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["term"].alias("term"),
            ((x["is_word"] == 1) & (F.get(up, i) <= x["start"]) & (F.get(down, i) >= x["end"])).alias("free")))))
        return F.transform(F.filter(every, lambda x: x["free"]), lambda x: F.struct(x["start"], x["end"], x["term"]))

    # at one place spans come before words
    tagged = F.concat(F.transform(words, lambda w: F.struct(w["start"].alias("start"), F.lit(1).alias("is_word"), w["end"].alias("end"),
                                                            w["term"].alias("term"))),
                      F.transform(spans, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("is_word"), b["end"].alias("end"),
                                                            F.lit(0).cast("bigint").alias("term"))))
    return F.when(F.size(spans) <= FEW_SPANS, F.filter(words, compared)).otherwise(bind(F.array_sort(tagged), swept))


def terms_of(text: Column, spans: Column) -> Column:
    """The terms of a text with their places; words within base spans are replaced with them anyway."""
    found = F.transform(matches(text, WORDS), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.xxhash64(F.lower(m["value"])).alias("term")))
    return bind(found, lambda words: outside(words, spans))


def distinct_terms(text: Column) -> Column:
    """The hashes of the distinct words of a text, the same as in ``terms_of``."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(F.lower(w))))


def found_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, h, key, base, entities, t)`` for every row; ``h`` is a hash of the
    text, ``key`` one of id and text; the text itself only where entities are."""
    t = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    t = t.withColumn("base", base_spans(F.col("t"))).withColumn("h", F.xxhash64("t"))
    some = F.size("base") > 0
    return t.select("doc_id", "h", F.xxhash64("doc_id", "h").alias("key"), "base",
                    F.when(some, entities_of(F.col("t"), F.col("base"))).alias("entities"), F.when(some, F.col("t")).alias("t"))


def term_counts(docs: DataFrame, repeated: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(term, df)``: distinct documents in which a term occurs, over whole texts. ``repeated``
    ``(key, m)`` tells the keys of ``found_entities`` that stand m > 1 times: all rows are
    counted, and the further copies of those taken off."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    counts = docs.select(F.explode(distinct_terms(text)).alias("term"), F.lit(1).cast("bigint").alias("n"))
    if repeated is not None:
        rows = docs.select(col(id_col).alias("doc_id"), text.alias("t")).withColumn("key", F.xxhash64("doc_id", F.xxhash64("t")))
        once = rows.join(repeated, "key").groupBy("key").agg(F.first("t").alias("t"), F.first("m").alias("m"))
        counts = counts.union(once.select(F.explode(distinct_terms(F.col("t"))).alias("term"), (1 - F.col("m")).alias("n")))
    return counts.groupBy("term").agg(F.sum("n").alias("df"))


def _salted(table: DataFrame) -> DataFrame:
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))


def _salt() -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(SALTS))


def _class() -> Column:
    """A digest of the distinct documents of a group: equal for groups of the very same ones."""
    return F.xxhash64(F.count(F.lit(1)), F.bit_xor("key"), F.bit_xor(F.xxhash64("key", F.lit(1))))


def listed_terms(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``(key, known, words)``: of every document with entities of ``support`` documents or
    more the classes of those, ``known``, with their counts, and its terms."""
    held = found.filter(F.size("base") > 0).dropDuplicates(["key"])
    each = held.select("key", F.explode("entities").alias("entity"))
    entities = each.groupBy("entity").agg(F.count("*").alias("df_c"), _class().alias("c")).filter(F.col("df_c") >= support)
    known = (each.withColumn("salt", _salt()).join(_salted(entities), ["entity", "salt"])
             .groupBy("key").agg(F.collect_set(F.struct("c", "df_c")).alias("known")))
    return held.select("key", "t", "base").join(known, "key").select(
        "key", "known", terms_of(F.col("t"), F.col("base")).alias("words"))


def classed_terms(listed: DataFrame, counts: DataFrame, n: int, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """``(term, w, df)``: the terms that may disclose something, their class and corpus count."""
    each = listed.select("key", F.explode(F.array_distinct(F.col("words.term"))).alias("term"))
    terms = each.groupBy("term").agg(F.count("*").alias("in_listed"), _class().alias("w")).filter(F.col("in_listed") >= support)
    top = listed.agg(F.max(F.array_max(F.transform("known", lambda k: k["df_c"])))).first()[0] or 0
    # PMI / IC >= s needs df(t) <= df(c,t) (N / df(c))^(1-s), and df(c,t) is df(c) at most
    bound = float(top) ** least * float(max(n, 1)) ** (1 - least) * 1.0001
    return terms.join(counts.filter(F.col("df") <= bound), "term").select("term", "w", "df")


def paired_classes(listed: DataFrame, terms: DataFrame) -> DataFrame:
    """``(key, c, df_c, w)``: the classes of entities and of terms that a document holds both."""
    each = listed.select("key", "known", F.explode(F.array_distinct(F.col("words.term"))).alias("term"))
    of_doc = (each.withColumn("salt", _salt()).join(_salted(terms.select("term", "w")), ["term", "salt"])
              .groupBy("key").agg(F.first("known").alias("known"), F.collect_set("w").alias("ws")))
    return (of_doc.select("key", "known", F.explode("ws").alias("w"))
            .select("key", "w", F.explode("known").alias("k")).select("key", "k.c", "k.df_c", "w"))


def disclosing(pairs: DataFrame, terms: DataFrame, n: int, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """``(c, w, term, share)``: terms that disclose at least the share ``least`` of the entities of a class."""
    counted = pairs.groupBy("c", "df_c", "w").agg(F.count("*").alias("df_ct")).filter(F.col("df_ct") >= support)
    total = F.lit(float(max(n, 1)))
    pmi = F.log2(total * F.col("df_ct") / (F.col("df_c") * F.col("df")))
    ic = F.log2(total / F.col("df_c"))
    share = F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0))
    return (counted.withColumn("salt", F.pmod(F.xxhash64("c"), F.lit(SALTS))).join(_salted(terms), ["w", "salt"])
            .select("c", "w", "term", share.alias("share")).filter(F.col("share") >= least))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
         generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``(doc_id, h, base, spans)`` for every row: spans holds the base ones and
    those of disclosing terms (kind 4: to be generalised, 5: to be removed)."""
    ensure_checkpoint_dir(docs.sparkSession)
    found = found_entities(docs, id_col, text_col).checkpoint()
    keys = found.groupBy("key").agg(F.count("*").alias("m")).checkpoint()
    n, most = keys.agg(F.count("*"), F.max("m")).first()
    counts = term_counts(docs, keys.filter("m > 1") if (most or 0) > 1 else None, id_col, text_col)
    listed = listed_terms(found, support).checkpoint()
    terms = classed_terms(listed, counts, n, support, generalise).checkpoint()
    pairs = paired_classes(listed, terms).checkpoint()
    told = disclosing(pairs, terms, n, support, generalise)
    hit = (pairs.withColumn("salt", _salt()).join(_salted(told), ["c", "w", "salt"])
           .groupBy("key", "term").agg(F.max("share").alias("share")))
    places = listed.select("key", F.explode("words").alias("p")).select("key", "p.term", "p.start", "p.end")
    kind = F.when(F.col("share") >= remove, F.lit(_REMOVED)).otherwise(F.lit(_GENERALISED))
    marked = (places.join(hit, ["key", "term"]).groupBy("key")
              .agg(F.collect_list(F.struct("start", kind.alias("kind"), "end")).alias("terms")))
    with_terms = found.filter(F.size("base") > 0).join(marked, "key", "left")
    added = F.coalesce("terms", F.array().cast(KIND))
    return (with_terms.select("doc_id", "h", "base", in_order(F.col("base"), added).alias("spans"))
            .union(found.filter(F.size("base") == 0).select("doc_id", "h", "base", F.col("base").alias("spans"))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and the terms that disclose it replaced by marks
    or removed; rows without any pass unchanged. A null text stays null."""
    hits = scan(docs, id_col, text_col).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "spans").dropDuplicates(["_id", "_h"])
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d"), col(id_col).alias("_key"),
                       col(text_col).cast("string").alias("_t")).withColumn("_text_hash", F.xxhash64(F.coalesce("_t", F.lit(""))))
    joined = rows.join(hits, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_h")), "left")
    clean = F.when(F.col("spans").isNull(), F.col("_t")).otherwise(replaced(F.col("_t"), F.col("spans"), MARKS))
    made = joined.select("d", clean.alias("_clean"))
    return made.select(*[F.col("_clean").alias(c) if c == text_col else F.col("d")[c].alias(c) for c in docs.columns])


__all__ = ["KINDS", "base_spans", "count_of", "named", "sanitise", "scan"]
