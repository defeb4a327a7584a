"""Integer quotas by the largest-remainder rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.functions import half_even


def largest_remainder(
    df: DataFrame,
    capacity: str,
    budget: Column,
    key: str,
    within: Sequence[str] = (),
    out: str = "quota",
) -> DataFrame:
    """Spread `budget` over rows in proportion to `capacity`, in whole numbers, never above it.

    Shares are rounded down; what is left goes one by one to the largest
    fractions (ties by `key`). `df` is a small table: one row per file or class.
    """
    group = W.partitionBy(*within)
    cap = F.col(capacity)
    total = F.sum(cap).over(group)
    step = df.withColumn("_total", total).withColumn("_budget", F.greatest(F.lit(0), F.least(budget, F.col("_total"))))
    raw = F.when(F.col("_total") == 0, F.lit(0.0)).otherwise(
        F.col("_budget").cast("double") * cap / F.col("_total")
    )
    step = step.withColumn("_raw", raw).withColumn("_base", F.least(F.floor("_raw"), cap))
    step = step.withColumn("_left", F.col("_budget") - F.sum("_base").over(group))
    turn = F.row_number().over(
        group.orderBy((F.col("_base") < cap).desc(), (F.col("_raw") - F.col("_base")).desc(), F.col(key))
    )
    step = step.withColumn("_turn", turn)
    bonus = ((F.col("_turn") <= F.col("_left")) & (F.col("_base") < cap)).cast("long")
    return step.withColumn(out, F.col("_base") + bonus).drop("_total", "_budget", "_raw", "_base", "_left", "_turn")


def family_balanced(
    files: DataFrame, target: Column, family: str = "source_class_folder", out: str = "train_attack_quota"
) -> DataFrame:
    """Equal base quota per family, small families give all, the rest in proportion to what remains;
    inside a family the quota is spread over its files."""
    families = files.groupBy(family).agg(F.sum("rows").alias("_rows"))
    everything = W.partitionBy()
    families = families.withColumn("_goal", F.least(target, F.sum("_rows").over(everything)))
    base = F.floor(F.col("_goal") / F.count(F.lit(1)).over(everything))
    families = families.withColumn("_first", F.greatest(F.lit(0), F.least(base, F.col("_rows"))))
    families = families.withColumn("_residual", F.col("_rows") - F.col("_first"))
    families = families.withColumn("_open", F.col("_goal") - F.sum("_first").over(everything))
    families = largest_remainder(families, "_residual", F.col("_open"), family, out="_extra")
    quota = families.select(family, (F.col("_first") + F.col("_extra")).alias("_family_quota"))
    return largest_remainder(
        files.join(quota, family), "rows", F.col("_family_quota"), "source_relative_file", [family], out
    ).drop("_family_quota")


def train_attack_quotas(manifest: DataFrame, ratio: float = 1.0, policy: str = "family_balanced") -> DataFrame:
    """Add `train_attack_quota`: attack rows to keep per training file, about `ratio` per benign row."""
    if policy != "family_balanced":
        raise ValueError(f"unknown quota policy {policy!r}")
    in_train = manifest.where("split = 'train'")
    totals = in_train.agg(
        F.coalesce(F.sum(F.when(F.col("target_binary") == 0, F.col("rows"))), F.lit(0)).alias("benign"),
        F.coalesce(F.sum(F.when(F.col("target_binary") == 1, F.col("rows"))), F.lit(0)).alias("attack"),
    )
    target = totals.select(F.least(half_even(F.col("benign") * F.lit(float(ratio))), F.col("attack"))).scalar()
    quotas = family_balanced(in_train.where("target_binary = 1"), target)
    quotas = quotas.select("source_relative_file", "train_attack_quota")
    return manifest.join(quotas, "source_relative_file", "left").withColumn(
        "train_attack_quota", F.coalesce("train_attack_quota", F.lit(0)).cast("long")
    )
