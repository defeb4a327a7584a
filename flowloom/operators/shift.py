"""Domain shift between two benign populations."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.contracts import KEY_FEATURES
from flowloom.operators.quantiles import exact_quantiles
from flowloom.session import literal_table
from flowloom.sources.files import exists, read_text

_SHIFT_SCHEMA = "feature string, base_median double, other_median double, ratio double, base_p95 double, other_p95 double"


def domain_shift(base: DataFrame, other: DataFrame, features: Sequence[str], **tuning: int) -> DataFrame:
    """Median and 95th percentile of both populations and the ratio of medians; NULL over a zero base."""
    shared = [f for f in features if f in base.columns and f in other.columns]
    a = exact_quantiles(base, shared, [0.5, 0.95], **tuning)
    b = exact_quantiles(other, shared, [0.5, 0.95], **tuning)
    rows = [
        (f, a[f][0], b[f][0], b[f][0] / a[f][0] if a[f][0] and b[f][0] is not None else None, a[f][1], b[f][1])
        for f in shared
    ]
    return literal_table(base.sparkSession, rows, _SHIFT_SCHEMA)


def shift_severity(shift: DataFrame) -> DataFrame:
    """strong beyond 10x, moderate beyond 3x; `counted` marks beyond 5x. A zero or missing ratio never counts."""
    r = F.round("ratio", 2)
    return shift.withColumn(
        "severity",
        F.when((r > 10) | (r < 0.1), "strong").when((r > 3) | (r < 0.33), "moderate").otherwise("none"),
    ).withColumn("counted", F.coalesce((r != 0) & ((r > 5) | (r < 0.2)), F.lit(False)).cast("int"))


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def load_top_features(path: str | Path, n: int = 15) -> list[str]:
    """Most important features from a small JSON file in either published shape; key features if there is none."""
    if not exists(path):
        return KEY_FEATURES[:n]
    raw = json.loads(read_text(path))
    pairs = zip(raw["Feature"], raw["Importance"]) if "Feature" in raw else raw.items()
    return [f for f, _ in sorted(pairs, key=lambda x: -x[1])[:n]]
