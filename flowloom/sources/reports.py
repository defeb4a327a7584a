"""Sinks for result tables of a few hundred rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Result table as JSON lines, Parquet, or CSV with header and byte-order mark."""
    one = df.coalesce(1).write
    if fmt == "json":
        one.json(path)
    elif fmt == "parquet":
        one.option("compression", "zstd").parquet(path)
    elif fmt == "csv":
        marked = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
        marked.coalesce(1).write.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")
