"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.llm import (
    decontaminate,
    divergence,
    licenses,
    packing,
    passages,
    quality,
    runs,
    simhash,
    suffixes,
    token_counts,
    token_files,
    topk,
    toxicity,
)
from moodloom.llm.common import held, read_table
from moodloom.llm.oracles import ORACLES as ORACLES  # read by __spark_entry__
from moodloom.sources.staging import staging_path

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line", "license_id", "n_common", F.round("dice", 9).alias("dice"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "token-files")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2)
    read = token_files.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = decontaminate.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return result.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_documents(read_table(spark, sf_dir, "documents"), TOKENIZER, end_id=0)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack_pieces(digests)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(documents, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(documents, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.build_ledger(read_table(spark, sf_dir, "documents"))
    judged = quality.apply_policy(ledger, quality.POLICIES[-1])
    base_failed = quality.fails(quality.POLICIES[0].mask).alias("base_failed")
    return judged.select("doc_id", *quality.MEASURES, "failures", base_failed, "kept")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def with_cycles(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the planted cycles: one in ten documents repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)).alias("w")
    n, g = F.size("w"), F.floor(h / 10)
    begin = (g % n).cast("int")
    period = (F.floor((n - F.col("a")) / (3 + g % 8)) + 1).cast("int")
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    cycled = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i)))
    split = docs.select("doc_id", "text", held(found))
    split = split.select("doc_id", "text", F.col("col").alias("w")).withColumn("a", F.when(n > 0, begin)).withColumn("p", period)
    return split.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(cycled, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_cycles(read_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    shown = found.select("*", best.alias("best"), F.array_join(lines, "").alias("lines"))
    shown = shown.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"), F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return shown.withColumn("exponent_milli", F.expr("(1000L * length) div period"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read_table(spark, sf_dir, "documents"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_passages": op1_passages,
    "op2_license_scan": op2_license_scan,
    "op3_token_files": op3_token_files,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_top_k": op13_top_k,
}
