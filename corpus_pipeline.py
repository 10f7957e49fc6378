"""A corpus pipeline over ``documents``: quality rules, near duplicates, secrets, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet in the shared folder and
read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.

1. quality_rules: rows that fail the base rules or a certified cutoff go.
2. jaccard_join: of each group of near duplicates (five-word shingles,
   Jaccard 0.8 or more) the row with the smallest id stays.
3. secret_scan: found secrets become ``[kind]`` in the text; n_chars follows.
4. packing: what is left is tokenized and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtside.llm import jaccard_join, packing, quality, secret_scan
from courtside.llm.common import read_table, ship_package
from courtside.operators.materialize import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs, 5, 80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("jaccard_join", near_duplicates), ("secret_scan", secrets), ("packing", pack)]

#: Tokenizing, thresholds and sequence numbers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents`` to packed pieces."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
