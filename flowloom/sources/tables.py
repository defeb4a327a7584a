"""Tables that change at once: data first, one small commit last, readers follow the newest commit.

A version is a folder of its own below `data/`; a commit is one row below `commits/` that names it. A job
that dies between its parts leaves a folder that nobody reads; the table before it stays as it was. Nothing is
renamed or overwritten, so this holds on object stores too. Old versions stay readable until someone clears them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.session import literal_table

_COMMIT = "data string, committed bigint"


def commit(df: DataFrame, path: str, partition_by: Sequence[str] = (), add: bool = False) -> str:
    """Write `df` as the new content of the table, or with `add` as more of it, and return the folder of what was written."""
    folder = f"data/{uuid.uuid4().hex}"
    before = _newest(df.sparkSession, path)[1] if add else []
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(f"{path}/{folder}")
    row = literal_table(df.sparkSession, [(",".join([*before, folder]), time.time_ns())], _COMMIT)
    row.coalesce(1).write.json(f"{path}/commits/{uuid.uuid4().hex}")
    return f"{path}/{folder}"


def _newest(spark: SparkSession, path: str, as_of: int | None = None) -> tuple[int | None, list[str]]:
    try:
        commits = spark.read.schema(_COMMIT).json(f"{path}/commits/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, []
    if as_of is not None:
        commits = commits.where(F.col("committed") <= as_of)
    row = commits.agg(F.max_by(F.struct("data", "committed"), F.struct("committed", "data")).alias("c")).first().c
    return (row.committed, row.data.split(",")) if row else (None, [])


def read_table(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The table as of its newest commit, or the newest one up to `as_of` (nanoseconds since 1970)."""
    _, folders = _newest(spark, path, as_of)
    if not folders:
        raise FileNotFoundError(f"no committed table at {path}")
    parts = [spark.read.parquet(f"{path}/{f}") for f in folders]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(data, committed) of every commit."""
    return spark.read.schema(_COMMIT).json(f"{path}/commits/*")
