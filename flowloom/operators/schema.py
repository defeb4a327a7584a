"""Column alignment: names, order, types and lineage columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.contracts import BENIGN_FOLDER, DROP_COLUMNS, META_COLUMNS
from flowloom.functions import named, numeric


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    have = set(df.columns)
    absent = [c for c in columns if c not in have]
    if absent:
        raise ValueError(f"{len(absent)} columns are missing, first: {absent[:10]}")


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly `columns` in that order: absent ones as NULL text, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[named(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def align_present(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The contract columns that exist, plus the names of those that do not."""
    have = set(df.columns)
    absent = [c for c in columns if c not in have]
    return df.select(*[named(c) for c in columns if c in have], *[named(c) for c in keep]), absent


def align_foreign(
    df: DataFrame, renames: Mapping[str, str], features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Rename a foreign schema, require every feature, project it as float32.

    Rename, check and cast are one projection, so only the needed columns are read.
    """
    renamed = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    require_columns(renamed, features)
    return renamed.select(*[named(c) for c in keep], *[named(c).cast("float").alias(c) for c in features])


def to_numeric(df: DataFrame, exclude: Sequence[str] = META_COLUMNS) -> DataFrame:
    """Every column outside `exclude` from text to float32; bad cells become NULL, infinities stay."""
    keep = set(exclude)
    return df.select(*[named(c) if c in keep else numeric(named(c)).alias(c) for c in df.columns])


def stamp(df: DataFrame, dataset: str) -> DataFrame:
    """Add dataset name, raw label and the binary target that follows from the class folder."""
    return df.withColumns(
        {
            "source_dataset": F.lit(dataset),
            "target_binary": F.when(F.col("source_class_folder") == BENIGN_FOLDER, 0).otherwise(1).cast("byte"),
            "raw_stage2_label": F.col("source_class_folder"),
        }
    )


def drop_identity(df: DataFrame, columns: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name; every frame must hold the same columns."""
    for other in others:
        first = first.unionByName(other)
    return first
