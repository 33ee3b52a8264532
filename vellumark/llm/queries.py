"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellumark.llm import (
    chunked_bpe,
    extraction,
    fill_middle,
    fingerprints,
    jaccard,
    packing,
    quality,
    rans,
    repair,
    rules,
    substrings,
    topk,
    toxicity,
)
from vellumark.llm.oracles import ORACLES as ORACLES
from vellumark.llm.scan import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"), size=3, percent=90)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.read_token_digests(rans.write_token_files(table(spark, sf_dir, "documents")))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest_of_hundredths(table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.transform_digests(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_quality": op9_quality,
    "op10_token_files": op10_token_files,
    "op11_exact_topk": op11_exact_topk,
    "op12_fill_middle": op12_fill_middle,
    "op13_conversation_repair": op13_conversation_repair,
}
