"""Label normalisation, taxonomy lookup and class distributions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.contracts import CLASS_NAMES, TAXONOMIES
from flowloom.functions import named, squeeze_label
from flowloom.session import literal_table


def taxonomy_table(spark: SparkSession, taxonomies: Mapping[str, Mapping[str, int]] = TAXONOMIES) -> DataFrame:
    """Dimension (taxonomy, label, class_id); one row per known label."""
    rows = [(t, label, cid) for t, table in taxonomies.items() for label, cid in table.items()]
    return literal_table(spark, rows, "taxonomy string, label string, class_id int")


def class_table(spark: SparkSession, names: list[str] = CLASS_NAMES) -> DataFrame:
    return literal_table(spark, list(enumerate(names)), "class_id int, class_name string")


def map_labels(df: DataFrame, dim: DataFrame, taxonomy: str, label_col: str = "label") -> DataFrame:
    """Add `class_id`, NULL where the taxonomy does not know the label."""
    known = dim.where(F.col("taxonomy") == taxonomy).select(F.col("label").alias("_known"), "class_id")
    return (
        df.withColumn("_norm", squeeze_label(named(label_col)))
        .join(known, F.col("_norm") == F.col("_known"), "left")
        .drop("_norm", "_known")
    )


def unknown_labels(df: DataFrame, dim: DataFrame, taxonomy: str, label_col: str = "label") -> DataFrame:
    """How many rows each unknown raw label costs; counted per spelling before the lookup."""
    spellings = df.groupBy(named(label_col).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    return map_labels(spellings, dim, taxonomy).where("class_id IS NULL").select("label", "row_count")


def known_rows(df: DataFrame, dim: DataFrame, taxonomy: str, label_col: str = "label") -> DataFrame:
    return map_labels(df, dim, taxonomy, label_col).where("class_id IS NOT NULL")


def attack_flag(label: Column, benign_value: str) -> Column:
    """1 unless the label is exactly the benign value; a missing label counts as attack."""
    return (~label.eqNullSafe(F.lit(benign_value))).cast("int")


def class_distribution(df: DataFrame, names: DataFrame, by: str = "split") -> DataFrame:
    """Rows per split and class, with class names."""
    counts = df.groupBy(by, "class_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(names, "class_id", "left").select(by, "class_id", "class_name", "row_count")


def label_frequency(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows and share of the total per raw label, most frequent first."""
    counts = df.groupBy(named(label_col).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("pct", F.col("row_count") / total * 100).orderBy(F.desc("row_count"), "label")


def taxonomy_differences(dim: DataFrame, first: str, second: str) -> DataFrame:
    """Labels that two taxonomies map to different classes, or that only one of them knows."""
    a = dim.where(F.col("taxonomy") == first).select("label", F.col("class_id").alias("first_class"))
    b = dim.where(F.col("taxonomy") == second).select("label", F.col("class_id").alias("second_class"))
    both = a.join(b, "label", "full")
    return both.where(~F.col("first_class").eqNullSafe(F.col("second_class")))
