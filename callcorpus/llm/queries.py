"""Registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common as C
from . import conversation_repair, decontaminate, langid, line_dedup, mixing, near_dedup, quality_rules, sharding, spelling, substring_dedup, token_counts, toxicity, url_filter


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixture(C.table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * F.col("copies")).alias("taken"), "source")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = C.store(quality_rules.ledger(C.table(spark, sf_dir, "documents")), "ledger")
    newest = quality_rules.POLICIES["v2"]
    lost = quality_rules.ablation(led, newest).select(F.col("rule").alias("sole_rule"), F.col("n_failed_only_this").alias("n_sole"))  # a row per rule
    out = quality_rules.apply_policies(led).withColumn("sole_rule", quality_rules.sole_rule(newest)).join(F.broadcast(lost), "sole_rule", "left")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("keep_base")).alias("base_failed"),
        F.col("keep_v1").alias("kept"), "fail_bits", "keep_v2", "sole_rule", "n_sole",
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(C.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", F.coalesce("nearest", F.lit(langid.UNDETERMINED)).alias("lang_pred"), "score", "distance", "rejected", "lang_found")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("evidence").alias("n_neighbours"), "looked_up")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.section_tokens(C.table(spark, sf_dir, "documents"))
    return found.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(C.table(spark, sf_dir, "pages"), url_filter.rules_table(spark))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(C.table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return done.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", F.length("text").cast("long").alias("kept_chars"), kept.alias("kept_sha256"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.assign(C.table(spark, sf_dir, "documents"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(C.table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(C.table(spark, sf_dir, "conversations")))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(C.table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.damaged(C.table(spark, sf_dir, "documents"), every=199)
    return spelling.group_variants(spelling.vocabulary(runs))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_langid": op5_langid,
    "op6_near_dedup": op6_near_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_filter": op8_url_filter,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_repair": op11_repair,
    "op12_sharding": op12_sharding,
    "op13_spelling": op13_spelling,
}
