"""Loads that become visible whole or not at all, and surrogate keys that last.

A ``Releases`` folder holds every load under ``loads/<number>`` (the seven
contract tables, and ``keys/<id column>``: each natural key with its id) and a
commit log.  A load is written beside the current one, checked there, and
then one row is appended to the log: that single commit is the swap.  Readers
take the tables of the largest committed number, so they see the old state
until then and the new one after it; a load that fails anywhere before leaves
only unused files, which the next load of that number overwrites.  One writer
at a time is assumed.

``KeyStore`` numbers natural keys (``operators.keys.stable_ids``) against the
keys of the current load: known keys keep their id, new ones go on from the
largest.  Keys that a load no longer has stay in the store, so their ids are
never given to others.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.keys import stable_ids
from courtside.sources.files import conform


class KeyStore:
    """The ids of the current load and, after a build, those of the next."""

    def __init__(self, known: Callable[[str], DataFrame | None]):
        self.known, self.next, self._lock = known, {}, threading.Lock()

    def number(self, df: DataFrame, order: Sequence[str], id_col: str) -> DataFrame:
        """See ``stable_ids``; ``id_col`` names the key's table in the store."""
        before = self.known(id_col)
        ided = stable_ids(df, order, id_col, before)
        keys = ided.select(*order, id_col)
        if before is not None:
            gone = before.join(keys.select(F.col(id_col).alias("_kid")), F.col(id_col) == F.col("_kid"), "left_anti")
            keys = keys.unionByName(gone.select(*order, id_col))
        with self._lock:
            self.next[id_col] = keys
        return ided


class Releases:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def current(self) -> int:
        """Number of the committed load; 0 before the first."""
        try:
            return self.spark.read.schema("load bigint, committed timestamp").parquet(f"{self.location}/commits").agg(F.max("load")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise

    def _path(self, load: int, table: str) -> str:
        return f"{self.location}/loads/{load:06d}/{table}"

    def table(self, name: str, load: int | None = None) -> DataFrame:
        """A table of the committed (or a given) load."""
        load = self.current() if load is None else load
        if not load:
            raise ValueError(f"{self.location} has no committed load")
        return self.spark.read.parquet(self._path(load, name))

    def keys(self) -> KeyStore:
        """The ids to go on from."""
        load = self.current()

        def known(id_col: str) -> DataFrame | None:
            try:
                return self.table(f"keys/{id_col}", load) if load else None
            except AnalysisException as e:
                if e.getCondition() == "PATH_NOT_FOUND":
                    return None
                raise

        return KeyStore(known)

    def stage(self, tables: dict[str, DataFrame], keys: KeyStore | None = None, partition_by: dict[str, Sequence[str]] | None = None) -> int:
        """Write the tables (under their contracts) and keys of the next load; its number."""
        load = self.current() + 1
        for name, df in tables.items():
            conform(df, name).write.mode("overwrite").partitionBy(*(partition_by or {}).get(name, ())).parquet(self._path(load, name))
        for id_col, df in (keys.next if keys else {}).items():
            df.write.mode("overwrite").parquet(self._path(load, f"keys/{id_col}"))
        return load

    def commit(self, load: int) -> None:
        """Make a staged load the current one."""
        if load != self.current() + 1:
            raise ValueError(f"load {load} does not follow the committed load {self.current()}")
        one = self.spark.range(1).select(F.lit(load).cast("bigint").alias("load"), F.current_timestamp().alias("committed"))
        one.coalesce(1).write.mode("append").parquet(f"{self.location}/commits")

    def publish(self, database: str, names: Sequence[str]) -> None:
        """Views of the committed tables in the session catalog."""
        load = self.current()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name in names:
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{self._path(load, name)}`")
