"""Cut lineage by writing a Parquet table into the shared checkpoint folder.

Used where one result is read twice (the fact before its game numbering,
the range-partitioned keys of ``number_rows``): the plan runs once, a lost
executor only costs re-reading files, and Parquet keeps column pruning for
the second reader.  The folder is the session's ``spark.checkpoint.dir``
(see ``session.ensure_checkpoint_dir``), never a machine-local default on a
cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from courtside.session import ensure_checkpoint_dir


def scratch_path(df: DataFrame, name: str) -> str:
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return f"{base}/courtside/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back."""
    path = scratch_path(df, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
