"""The registered corpus queries, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import fim, forest, language, leaks, licences, mixing, periods, quality, repeats, secrets, sharding, simhash, tokens
from feedloom.llm.common import NOT_SPACE, table, words
from feedloom.llm.oracles import ORACLES
from feedloom.sinks.tables import scratch_dir


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is the one version of its path; the ledger is new, so every blob is scanned."""
    versions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    found = secrets.scan(versions, scratch_dir(spark, "ledger"))
    base_kinds = [r.kind for r in secrets.RULES if r.base]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(base_kinds))
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(kind) for kind in base_kinds],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    measured = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *measured, "base_failed", "kept", "rejected_by")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), sharding.QUERY_LIMIT)


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leaks.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = F.array_sort(F.map_entries("mixture"))
    listed = F.transform(shares, lambda e: F.format_string("%s:%.3f", e["key"], e["value"]))
    return language.identify(table(spark, sf_dir, "documents")).withColumn("mixture", F.array_join(listed, ","))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find(table(spark, sf_dir, "documents"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_copies(table(spark, sf_dir, "embeddings"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract makes every tenth text periodic from some word on, then asks for the runs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    chosen = (h % 10 == 0) & F.col("text").rlike(NOT_SPACE)
    docs = docs.withColumn("words", F.when(chosen, words(F.col("text"))))
    n = F.size("words").cast("bigint")
    first = g % n
    period = 1 + F.floor((n - first) / (3 + g % 8))

    cycle = F.slice("words", (first + 1).cast("int"), period.cast("int"))
    cycles = F.flatten(F.array_repeat(cycle, F.ceil((n - first) / period).cast("int")))
    parts = F.slice("words", 1, first.cast("int")), F.slice(cycles, 1, (n - first).cast("int"))
    repeated = F.concat_ws(" ", *parts)
    docs = docs.select("doc_id", F.when(F.col("words").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))
    found = periods.find(docs).withColumn("best", periods.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.transform(table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan,
    "op2_token_counts": token_counts,
    "op3_simhash_near_dedup": simhash_near_dedup,
    "op4_language_id": language_id,
    "op5_licence_scan": licence_scan,
    "op6_quality_rules": quality_rules,
    "op7_extendible_sharding": extendible_sharding,
    "op8_benchmark_decontamination": benchmark_decontamination,
    "op9_source_mixing": source_mixing,
    "op10_substring_dedup": substring_dedup,
    "op11_embedding_near_dedup": embedding_near_dedup,
    "op12_periodic_runs": periodic_runs,
    "op13_fill_in_middle": fill_in_middle,
}
