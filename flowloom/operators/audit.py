"""Data-quality checks as rows (check, status, detail)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.contracts import contract_problems
from flowloom.functions import named
from flowloom.functions.columns import is_inf, is_missing
from flowloom.session import literal_table
from flowloom.sources.files import exists


class AuditError(RuntimeError):
    """At least one audit check failed."""


def _status(good: Column) -> Column:
    return F.when(good, "PASS").otherwise("FAIL")


def _number(c: Column) -> Column:
    return c.cast("string")


def known_checks(spark: SparkSession, results: Sequence[tuple[str, bool, str]]) -> DataFrame:
    """Check rows for facts known without reading data."""
    rows = [(name, "PASS" if good else "FAIL", detail) for name, good, detail in results]
    return literal_table(spark, rows, "check string, status string, detail string")


def contract_checks(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    problems = contract_problems(names)
    return known_checks(
        spark,
        [
            ("contract not empty", len(names) > 0, f"{len(names)} features"),
            ("contract without duplicates", not problems["duplicates"], ",".join(problems["duplicates"])),
            ("contract without meta columns", not problems["meta"], ",".join(problems["meta"])),
        ],
    )


def schema_checks(splits: Mapping[str, DataFrame], features: Sequence[str]) -> DataFrame:
    """All features in every split and the same columns everywhere; reads schemas only."""
    results = []
    for name, df in splits.items():
        absent = [f for f in features if f not in df.columns]
        results.append((f"all features in {name}", not absent, ",".join(absent[:5])))
    reference, *others = splits
    for name in others:
        same = sorted(splits[name].columns) == sorted(splits[reference].columns)
        results.append((f"same columns {reference}={name}", same, ""))
    return known_checks(next(iter(splits.values())).sparkSession, results)


def artefact_checks(spark: SparkSession, paths: Mapping[str, str | Path]) -> DataFrame:
    return known_checks(spark, [(f"exists: {n}", exists(p), str(p)) for n, p in paths.items()])


def split_overlap(df: DataFrame, key: str = "source_relative_file") -> DataFrame:
    """Files that occur in more than one split: two map-side-combined aggregates, no set on the driver."""
    return (
        df.groupBy(key, "split").agg(F.count(F.lit(1)).alias("_n")).groupBy(key)
        .agg(F.count(F.lit(1)).alias("split_count"))
        .where("split_count > 1")
    )


def overlap_checks(df: DataFrame, key: str = "source_relative_file") -> DataFrame:
    """One check per pair of splits."""
    def has(s):
        return F.max((F.col("split") == s).cast("int")) == 1

    per_file = df.groupBy(key).agg(*[has(s).alias(s) for s in ("train", "val", "test")])
    pairs = [("train", "val"), ("train", "test"), ("val", "test")]
    counts = per_file.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"{a}-{b}") for a, b in pairs])
    long = counts.unpivot([], [f"{a}-{b}" for a, b in pairs], "pair", "shared")
    return long.select(
        F.concat(F.lit("no file overlap "), "pair").alias("check"),
        _status(F.col("shared") == 0).alias("status"), _number(F.col("shared")).alias("detail"),
    )


FACT_KEYS = ["source_relative_file", "split", "source_class_folder"]


def split_facts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Everything the row checks need, in one scan: per file, split and class the rows, benign and attack rows, missing and infinite cells.

    The checks below take this table or the rows themselves; it has one row a file.
    """
    def cells(bad):
        return reduce(Column.__add__, (F.coalesce(bad(named(f)), F.lit(True)).cast("long") for f in features), F.lit(0).cast("long"))

    return df.groupBy(*FACT_KEYS).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("target_binary") == 0).alias("benign"), F.count_if(F.col("target_binary") == 1).alias("attack"),
        F.sum(cells(is_missing)).alias("nan_cells"), F.sum(cells(lambda c: F.coalesce(is_inf(c), F.lit(False)))).alias("inf_cells"))


def _as_facts(df: DataFrame) -> DataFrame:
    """Rows as facts of one row each, for checks that count rows."""
    if "nan_cells" in df.columns:
        return df
    return df.withColumns({"rows": F.lit(1), "benign": (F.col("target_binary") == 0).cast("int"), "attack": (F.col("target_binary") == 1).cast("int")})


def clean_checks(df: DataFrame, splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """No missing and no infinite cell left in any split; takes `split_facts`."""
    sums = df.agg(*(F.coalesce(F.sum(F.when(F.col("split") == s, F.col(f"{kind}_cells"))), F.lit(0)).alias(f"{kind}_{s}") for s in splits for kind in ("nan", "inf")))
    checks = [F.struct(F.lit(f"no {name} in {s}").alias("check"), F.col(f"{kind}_{s}").alias("n")) for s in splits for kind, name in (("nan", "NaN"), ("inf", "Inf"))]
    return sums.select(F.inline(F.array(*checks))).select("check", _status(F.col("n") == 0).alias("status"), _number(F.col("n")).alias("detail"))


def balance_check(df: DataFrame, low: float = 0.8, high: float = 1.2) -> DataFrame:
    """Attack rows per benign row of train lie between the limits."""
    counts = _as_facts(df).where("split = 'train'").agg(
        F.coalesce(F.sum("benign"), F.lit(0)).alias("b"), F.coalesce(F.sum("attack"), F.lit(0)).alias("a")
    )
    balance = F.when(F.col("b") > 0, F.col("a") / F.col("b")).otherwise(0.0)
    return counts.select(
        F.lit("train balance").alias("check"), _status(balance.between(low, high)).alias("status"),
        F.concat(F.lit("benign="), _number(F.col("b")), F.lit(" attack="), _number(F.col("a"))).alias("detail"),
    )


def coverage_checks(df: DataFrame, absent: Sequence[str], splits: Sequence[str] = ("val", "test")) -> DataFrame:
    """Classes that are expected to be absent from the given splits."""
    pairs = [(s, c) for s in splits for c in absent]
    rows = F.col("rows") if "nan_cells" in df.columns else F.lit(1)
    hits = [
        F.coalesce(F.sum(F.when((F.col("split") == s) & (F.col("source_class_folder") == c), rows)), F.lit(0)).alias(f"_{i}")
        for i, (s, c) in enumerate(pairs)
    ]
    cells = [
        F.struct(F.lit(f"{c} absent from {s}").alias("check"), F.col(f"_{i}").alias("n"))
        for i, (s, c) in enumerate(pairs)
    ]
    return df.agg(*hits).select(F.inline(F.array(*cells))).select(
        "check", _status(F.col("n") == 0).alias("status"), _number(F.col("n")).alias("detail")
    )


def metric_floor(metrics: DataFrame, metric: str = "f1", floor: float = 0.5, model: str = "model") -> DataFrame:
    """Every model reaches more than the floor."""
    return metrics.select(
        F.concat(F.col(model), F.lit(f" {metric} > {floor}")).alias("check"),
        _status(F.coalesce(F.col(metric) > floor, F.lit(False))).alias("status"),
        F.format_number(metric, 4).alias("detail"),
    )


def audit(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def audit_summary(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    ).withColumn("all_passed", (F.col("failed") == 0).cast("int"))


def enforce(checks: DataFrame) -> DataFrame:
    """Raise when any check failed; check tables are a handful of rows."""
    bad = [r.check for r in checks.where("status = 'FAIL'").select("check").collect()]
    if bad:
        raise AuditError(f"{len(bad)} audit checks failed: {bad}")
    return checks
