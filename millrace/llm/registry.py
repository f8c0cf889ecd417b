"""The queries of the numbered operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, interaction, line_dedup, mixing, near_dedup, packing, phrases, preference, quality, shared, suffix_tree_lm, token_counts, token_ids, url_filter
from .encoder import tokenizer_path
from .oracles import ORACLES


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = shared.Scratch(spark, "token-ids")
    token_ids.write(shared.table(spark, sf_dir, "documents"), f"{scratch.path}/ids", tokenizer_path("byte_bpe_50k.json"), 2)
    found = scratch.save(token_ids.summary(spark, f"{scratch.path}/ids"), "summary")
    scratch.drop("ids")
    return found


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = packing.pieces(shared.table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1)
    return packing.pack(spark, table)


def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_pairs(preference.neighbours(shared.table(spark, sf_dir, "conversations")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(spark, shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(spark, shared.table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(spark, shared.table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = shared.Scratch(spark, "token-counts")
    found = token_counts.count(spark, shared.table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), f"{scratch.path}/cache")
    return found.withColumn("over_limit", F.col("n_tokens") > 4096)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(spark, shared.table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared.table(spark, sf_dir, "pages")
    return url_filter.judge(spark, pages, url_filter.labels_of_pages(pages, shared.table(spark, sf_dir, "labels")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, shared.table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(spark, shared.table(spark, sf_dir, "documents"))).drop("source")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        *(op1_token_ids, op2_quality_rules, op3_packing, op4_preference, op5_decontamination, op6_suffix_tree, op7_line_dedup),
        *(op8_token_counts, op9_near_dedup, op10_url_filter, op11_phrases, op12_mixing, op13_filter_audit),
    )
}

__all__ = ["ORACLES", "QUERIES"]
