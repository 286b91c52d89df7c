"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontaminate, fingerprint, jaccard, lines, packing, phrases, ppm, quality, repeats, search, spelling, toxicity, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.drop_phrases(table(spark, sf_dir, "documents")).drop("kept")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_repeats": op2_repeats,
    "op3_warc": op3_warc,
    "op4_ppm": op4_ppm,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_order_minhash": op7_order_minhash,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_phrase_dedup": op12_phrase_dedup,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL = {
    "op1_line_dedup": lines.oracle_sql(),
    "op12_phrase_dedup": phrases.oracle_sql(),
    "op13_ranked_search": search.oracle_sql(),
}
