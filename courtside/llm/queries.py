"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import (ctw, html_blocks, jaccard_join, lemp_negatives, license_scan, packing, pfor, quality, secret_scan, spm_dropout, turn_repair,
                           url_filter, vp_search)
from courtside.llm.common import read_table


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm_dropout.round_trips(read_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op3_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.search(read_table(spark, sf_dir, "embeddings"), F.col("_id") % 100 == 0)


def op4_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(read_table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link_documents(read_table(spark, sf_dir, "documents"), 4, 85)
    return linked.select("doc_id", "n_shingles", "component_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.round_trip(read_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("_id") % 7 == 0, (F.col("_label") + 1) % 10).otherwise(F.col("_label"))
    return lemp_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("_id") % 100 == 0, moved)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audits(turn_repair.damage(read_table(spark, sf_dir, "conversations")), present_col="present")


QUERIES = {f.__name__: f for f in (op1_merge_dropout, op2_url_filter, op3_vp_tree_search, op4_context_tree_weighting, op5_html_extraction, op6_jaccard_join, op7_secret_scan, op8_packing, op9_token_files,
                                   op10_quality_rules, op11_license_scan, op12_hard_negatives, op13_conversation_repair)}
ORACLE = {"op2_url_filter": url_filter.oracle(), "op6_jaccard_join": jaccard_join.oracle(), "op11_license_scan": license_scan.oracle(),
          "op12_hard_negatives": lemp_negatives.oracle(), "op13_conversation_repair": turn_repair.oracle()}
