"""File and catalog I/O: CSV landing (all text), CSV sink, contract tables.

* ``read_csv_text``: the good records of CSV files, every column STRING,
  pruned; ``sources.csv_text`` says what is good and has the rejects.
* ``write_csv``: distributed CSV that ``read_csv_text`` gives back unchanged.
* ``create_contract_tables`` / ``drop_table`` / ``insert_overwrite`` /
  ``replace_table`` / ``read_contract``: Parquet tables in the session
  catalog with the seven output contracts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.sources import csv_text
from courtside.sources.schemas import CONTRACT_DDL, RAW_CSV_COLUMNS, RAW_TO_SOURCE, contract


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    return csv_text.read_checked(spark, path, columns, multi_line).rows


def read_exports(spark: SparkSession, folder: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """The raw CSV exports of a folder, by builder source name (see schemas)."""
    return {name: landing.rows for name, landing in land_exports(spark, folder, multi_line).items()}


def land_exports(spark: SparkSession, folder: str, multi_line: bool = False) -> dict[str, csv_text.Landing]:
    """Rows and rejects of the raw CSV exports of a folder, by builder source name."""
    folder = folder.rstrip("/")
    return {RAW_TO_SOURCE[f]: csv_text.read_checked(spark, f"{folder}/{f}.csv", cols, multi_line) for f, cols in RAW_CSV_COLUMNS.items()}


def quarantine(landings: dict[str, csv_text.Landing], path: str) -> dict[str, int]:
    """Store the rejects of all sources as one table (source, file, reason, text); their number per source."""
    every = None
    for name, landing in landings.items():
        one = landing.rejects.select(F.lit(name).alias("source"), "file", "reason", "text")
        every = one if every is None else every.unionByName(one)
    every.write.mode("overwrite").parquet(path)
    counted = {r["source"]: r["count"] for r in every.sparkSession.read.parquet(path).groupBy("source").count().collect()}
    return {name: counted.get(name, 0) for name in landings}


def write_csv(df: DataFrame, path: str) -> None:
    csv_text.write(df, path)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast ``df`` to the contract of ``table`` (contract order)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract(table).fields])


def create_contract_tables(spark: SparkSession, database: str, location: str | None = None,
                           tables: Sequence[str] | None = None) -> None:
    db_loc = f" LOCATION '{location.rstrip('/')}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{db_loc}")
    for t in tables or CONTRACT_DDL:
        loc = f" LOCATION '{location.rstrip('/')}/{t}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({CONTRACT_DDL[t]}) USING PARQUET{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert_overwrite(df: DataFrame, table: str, contract_name: str | None = None) -> None:
    """Overwrite an existing table's rows (columns matched by position)."""
    conform(df, contract_name or table.split(".")[-1]).write.mode("overwrite").insertInto(table)


def overwrite_partitions(df: DataFrame, table: str, contract_name: str | None = None) -> None:
    """Replace only the partitions of a partitioned table that ``df`` has rows of."""
    rows = conform(df, contract_name or table.split(".")[-1])
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def replace_table(df: DataFrame, table: str, contract_name: str | None = None,
                  partition_by: Sequence[str] = ()) -> None:
    """Replace a table (definition and rows) with the contract of ``df``."""
    w = conform(df, contract_name or table.split(".")[-1]).write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def read_contract(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(table)
    return df.select(*columns) if columns else df
