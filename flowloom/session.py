"""Session defaults and the shared-folder helpers that cut lineage safely."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster, spark-submit supplies the settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one is set only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="flowloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # only a folder of our own
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def literal_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few rows known in the program. Their size is part of the plan, so joins broadcast them."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) or [[] for _ in schema]
    table = pa.table([pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, schema)], schema.names)
    return spark.createDataFrame(table, schema)


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/flowloom/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a side result once, with the writer's `options`, and read it back.

    Losing an executor no longer recomputes it, and because the files have a
    known size Spark broadcasts it in later joins only if it is below
    spark.sql.autoBroadcastJoinThreshold.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
