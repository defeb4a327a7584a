"""File statistics and the leak-free split of whole files.

Everything here after `file_stats` works on one row per source file.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowloom.contracts import ATTACK_TARGETS, BENIGN_TARGETS, SPLITS

FILE_KEY = ["source_relative_file", "source_file_name", "source_class_folder", "target_binary"]


def file_stats(df: DataFrame) -> DataFrame:
    """Rows per source file; partial counts are merged before the shuffle."""
    return (
        df.groupBy(*FILE_KEY)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("target_binary", "source_class_folder", F.desc("rows"), "source_relative_file")
    )


def _fill(sizes: list[int], seeds: list[str], shares: Mapping[str, float]) -> Iterator[str]:
    """Seeds first, then always the split that is emptiest for its target."""
    total = sum(sizes)
    goal = {s: total * shares[s] for s in SPLITS}
    placed = dict.fromkeys(SPLITS, 0)
    for i, size in enumerate(sizes):
        if i < len(seeds):
            pick = seeds[i]
        else:
            pick = min(SPLITS, key=lambda s: placed[s] / goal[s] if goal[s] > 0 else float("inf"))
        placed[pick] += size
        yield pick


# Which splits the largest files of a group take first.
_BENIGN_SEEDS = {3: ["train", "val", "test"]}
_BENIGN_SEEDS_MANY = ["train", "train", "val", "test"]
_ATTACK_SEEDS = {1: ["train"], 2: ["train", "test"]}
_ATTACK_SEEDS_MANY = ["train", "val", "test"]


def _assign(stats: DataFrame, group: str, seeds_for, shares: Mapping[str, float]) -> DataFrame:
    """One task per group walks its file list in size order (the rule is sequential by nature)."""

    def walk(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values(["rows", "source_relative_file"], ascending=[False, True])
        seeds = seeds_for(len(files))
        return files.assign(split=list(_fill(files["rows"].tolist(), seeds, shares)))

    fields = StructType([*stats.schema.fields, StructField("split", StringType())])
    return stats.groupBy(group).applyInPandas(walk, schema=fields)


def split_benign(stats: DataFrame, shares: Mapping[str, float] = BENIGN_TARGETS) -> DataFrame:
    """Benign files to train/val/test; fewer than three files is an error."""

    def seeds_for(n: int) -> list[str]:
        if n < 3:
            raise ValueError(f"{n} benign files are too few to fill three splits")
        return _BENIGN_SEEDS.get(n, _BENIGN_SEEDS_MANY)

    return _assign(stats.where("target_binary = 0"), "target_binary", seeds_for, shares)


def split_attack(stats: DataFrame, shares: Mapping[str, float] = ATTACK_TARGETS) -> DataFrame:
    """Attack files to train/val/test, family by family and in parallel."""
    attack = stats.where("target_binary = 1")
    return _assign(attack, "source_class_folder", lambda n: _ATTACK_SEEDS.get(n, _ATTACK_SEEDS_MANY), shares)


def split_manifest(stats: DataFrame, attack_shares: Mapping[str, float] = ATTACK_TARGETS) -> DataFrame:
    """Every file with its split; a file without one fails the query."""
    both = split_benign(stats).unionByName(split_attack(stats, attack_shares))
    missing = stats.join(both.select("source_relative_file", "split"), "source_relative_file", "left")
    checked = F.when(
        F.col("split").isNull(), F.raise_error(F.concat(F.lit("no split for "), F.col("source_relative_file")))
    ).otherwise(F.col("split"))
    return missing.select(*FILE_KEY, "rows", checked.alias("split"))


def train_only_classes(df: DataFrame) -> DataFrame:
    """Classes that occur in train but neither in val nor in test."""
    return (
        df.groupBy("source_class_folder")
        .agg(
            F.max((F.col("split") == "train").cast("int")).alias("_train"),
            F.max((F.col("split") != "train").cast("int")).alias("_other"),
        )
        .where("_train = 1 AND _other = 0")
        .select("source_class_folder")
    )
