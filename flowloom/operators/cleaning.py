"""Dirty-value diagnosis, train-fitted filling and scaling."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import finite, is_inf, is_missing, named
from flowloom.operators.quantiles import WIDE, exact_quantiles
from flowloom.operators.schema import require_columns
from flowloom.session import literal_table
from flowloom.sources.files import read_text, write_text


def _per_feature(df: DataFrame, features: Sequence[str], measures) -> DataFrame:
    """One row per feature from wide aggregates.

    `measures(column)` gives named aggregates. Every chunk of features is one
    map-side-combined aggregate over its own columns only, turned to rows after.
    """
    if not features:
        nothing = df.select(F.lit(None).cast("double").alias("_none"))
        return _per_feature(nothing, ["_none"], measures).where(F.lit(False))
    tables = []
    for start in range(0, len(features), WIDE):
        part = features[start : start + WIDE]
        cells = [
            F.struct(F.lit(f).alias("feature"), *[m.alias(k) for k, m in measures(named(f)).items()]).alias(f"_{i}")
            for i, f in enumerate(part)
        ]
        wide = df.agg(*cells)
        tables.append(wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(part))]))))
    return reduce(DataFrame.unionByName, tables)


def _present(df: DataFrame, features: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [f for f in features if f in have]


def dirty_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Infinite and missing cells of every feature that exists."""
    return _per_feature(
        df,
        _present(df, features),
        lambda c: {
            "inf_count": F.count_if(is_inf(c) & ~F.isnan(c)),
            "nan_count": F.count_if(is_missing(c)),
            "total_rows": F.count(F.lit(1)),
        },
    )


def inf_nan_report(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Affected features with counts and percentages of all rows."""
    share = lambda c: F.col(c) * 100.0 / F.col("total_rows")
    return (
        dirty_counts(df, features)
        .where("inf_count > 0 OR nan_count > 0")
        .withColumns({"inf_pct": share("inf_count"), "nan_pct": share("nan_count")})
    )


def inf_nan_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Totals over all features: dirty cells and affected columns."""
    return dirty_counts(df, features).agg(
        F.coalesce(F.max("total_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("inf_count"), F.lit(0)).alias("total_inf_cells"),
        F.coalesce(F.sum("nan_count"), F.lit(0)).alias("total_nan_cells"),
        F.count_if(F.col("inf_count") > 0).alias("columns_affected_inf"),
        F.count_if(F.col("nan_count") > 0).alias("columns_affected_nan"),
    )


def drop_infinite(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Infinite and not-a-number cells become NULL."""
    return df.withColumns({f: finite(named(f)) for f in _present(df, features)})


def fit_fill(df: DataFrame, features: Sequence[str], strategy: str = "median", **tuning: int) -> dict[str, float]:
    """Fill value per feature from the training rows; absent or empty features get 0."""
    if strategy not in ("median", "mean", "zero"):
        raise ValueError(f"unknown fill strategy {strategy!r}")
    there = _present(df, features)
    fitted: dict[str, float | None] = {}
    if strategy == "median":
        fitted = {f: q[0] for f, q in exact_quantiles(df, there, [0.5], **tuning).items()}
    elif strategy == "mean" and there:
        means = _per_feature(df, there, lambda c: {"fill": F.avg(finite(c).cast("double"))})
        fitted = {r.feature: r.fill for r in means.collect()}
    return {f: float(fitted.get(f) or 0.0) for f in features}


def fill_table(spark: SparkSession, fills: Mapping[str, float]) -> DataFrame:
    return literal_table(spark, list(fills.items()), "feature string, fill double")


def apply_fill(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    """Missing cells take their fill value; one projection of literals, no join.

    A whole-number column whose fill value has a fraction becomes double.
    """
    whole = {"tinyint", "smallint", "int", "bigint"}
    types = {c: "double" if t in whole and c in fills and float(fills[c]) % 1 else t for c, t in df.dtypes}
    return df.withColumns(
        {
            f: F.when(is_missing(named(f)), F.lit(float(v)).cast(types[f])).otherwise(named(f).cast(types[f]))
            for f, v in fills.items()
            if f in types
        }
    )


def clean(df: DataFrame, features: Sequence[str], fills: Mapping[str, float]) -> DataFrame:
    """Infinite to missing, missing to fill value; other columns pass through."""
    return apply_fill(drop_infinite(df, features), {f: fills.get(f, 0.0) for f in features})


def zero_clean(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return clean(df, features, {})


def inference_clean(
    df: DataFrame, features: Sequence[str], fills: Mapping[str, float], keep: Sequence[str] = ()
) -> DataFrame:
    """Check, project to contract order, clean. Works on batch and streaming frames."""
    require_columns(df, features)
    projected = df.select(*[named(c) for c in keep if c not in set(features)], *[named(f) for f in features])
    return clean(projected, features, fills)


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population deviation per feature over finite cells; a zero deviation becomes 1."""
    stats = _per_feature(
        df,
        _present(df, features),
        lambda c: {"mean": F.avg(finite(c).cast("double")), "std": F.stddev_pop(finite(c).cast("double"))},
    )
    return stats.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """(value - mean) / std with the fitted numbers as literals."""
    fitted = {r.feature: (r.mean, r.std) for r in scaler.collect()}
    return df.withColumns(
        {f: (named(f) - F.lit(m)) / F.lit(s) for f, (m, s) in fitted.items() if m is not None and f in df.columns}
    )


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Min, max, mean, population deviation and count over finite cells; empty features left out."""

    def measures(c):
        v = finite(c).cast("double")
        return {"min": F.min(v), "max": F.max(v), "mean": F.avg(v), "std": F.stddev_pop(v), "n": F.count(v)}

    return _per_feature(df, _present(df, features), measures).where("n > 0")


def constant_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features with at most one distinct value on the training rows."""

    def measures(c):
        v = F.when(~F.isnan(c), c.cast("double"))
        return {"low": F.min(v), "high": F.max(v)}

    ends = _per_feature(df, _present(df, features), measures)
    return ends.where("low IS NULL OR low = high").select("feature")


def drop_constant(train: DataFrame, features: Sequence[str], *others: DataFrame) -> tuple[list[str], list[DataFrame]]:
    """Names kept, and train plus the other splits without the columns constant on train."""
    gone = [r.feature for r in constant_features(train, features).collect()]
    return [f for f in features if f not in gone], [df.drop(*gone) for df in (train, *others)]


def save_params(path: str | Path, features: Sequence[str], fills: Mapping[str, float], strategy: str) -> None:
    """Fitted cleaning parameters as JSON, one small file."""
    params = {"nan_strategy": strategy, "fill_values": dict(fills), "feature_count": len(features)}
    write_text(path, json.dumps({"feature_names": list(features), **params}, indent=2))


def load_params(path: str | Path) -> dict:
    """Read fitted parameters; fill values may stand under either of their two published keys."""
    raw = json.loads(read_text(path))
    fills = raw.get("fill_values") or raw.get("nan_fill_values")
    if fills is None:
        raise ValueError(f"{path} holds no fill values")
    names = raw.get("feature_names") or raw.get("features") or list(fills)
    return {"features": names, "fills": fills, "strategy": raw.get("nan_strategy", "median")}


def split_xy(df: DataFrame, features: Sequence[str], key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """Features and everything else as two tables that share the row key."""
    return df.select(key, *[named(f) for f in features]), df.drop(*features)


def rejoin_xy(x: DataFrame, y: DataFrame, key: str = "row_key") -> DataFrame:
    return x.join(y, key)
