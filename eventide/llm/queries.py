"""The registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import (bpe_replay, chat_windows, decontaminate, fill_in_middle, hypergeometric_shards, lm_backoff,
                          pii_sanitise, quality_attention, quality_rules, secret_scan, simhash_gph, toxicity_mil, whitening_jd)
from eventide.llm.spans import count_of, named
from eventide.sources.tables import read_table


def op1_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    fold = quality_attention.held_out()
    model = quality_attention.fit(docs, labels, ~fold)
    return quality_attention.score(docs, model).select(
        "doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_passages")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                               similarity=0.8, recall=0.99)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, kinds = F.col("base"), secret_scan.KINDS
    return found.select("d.doc_id", *[count_of(base, k).alias(f"n_{name}") for k, name in enumerate(kinds[:3])],
                        F.sha2(named(base, kinds), 256).alias("base_sha256"), named(F.col("spans"), kinds).alias("spans"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select("d.doc_id", *[f"q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_windows.digest(chat_windows.windows(turns))


def op6_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.length(text).cast("bigint") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = hypergeometric_shards.shuffle(rows, 24, ["doc_id", "size", "text_crc32"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op7_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe_replay.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = read_table(spark, sf_dir, "documents")
    coded = bpe_replay.recode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_simhash_gph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_gph.cluster(read_table(spark, sf_dir, "documents"), shingle=3, distance=2, seed=42)
    return found.select("doc_id", simhash_gph.hex_digits().alias("fingerprint"), "component_id")


def op9_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_sanitise.scan(read_table(spark, sf_dir, "documents"))
    base, kinds = F.col("base"), pii_sanitise.KINDS
    return found.select("doc_id", *[count_of(base, k).alias(f"n_{name}") for k, name in enumerate(kinds[:4])],
                        F.sha2(named(base, kinds), 256).alias("base_sha256"), named(F.col("spans"), kinds).alias("spans"))


def op10_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    fold = toxicity_mil.held_out()
    weights = toxicity_mil.fit(docs, labels, ~fold)
    return toxicity_mil.score(docs, weights).select(
        "doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences", "offending")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(read_table(spark, sf_dir, "documents"), rate=50, spm=80, seed=42)


def op12_lm_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_backoff.score(read_table(spark, sf_dir, "documents"), lm_backoff.ORDER, lm_backoff.STRENGTH)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))


def op13_whitening_jd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_jd.whiten(read_table(spark, sf_dir, "embeddings"), components=16)


QUERIES = {f.__name__: f for f in (op1_quality_attention, op2_decontaminate, op3_secret_scan, op4_quality_rules, op5_chat_windows, op6_hypergeometric_shards, op7_bpe_replay,
                                  op8_simhash_gph, op9_pii_sanitise, op10_toxicity_mil, op11_fill_in_middle,
                                  op12_lm_backoff, op13_whitening_jd)}

ORACLES: dict[str, str] = {"op5_chat_windows": chat_windows.SQL, "op11_fill_in_middle": fill_in_middle.SQL,
                           "op12_lm_backoff": lm_backoff.SQL}
