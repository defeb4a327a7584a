"""Exact ROC and precision-recall areas from prefix sums over sorted scores.

Rows are merged to one row per distinct score first, so a score that many rows
share costs nothing. The running sums are taken inside score ranges of about
equal weight and shifted by the totals of the ranges above, so that no single
task sorts all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


RANGE_SCORES = 250_000


def bucketize(df: DataFrame, score: str, edges: Sequence[float], out: str) -> DataFrame:
    """Number of edges that the score reaches (score >= edge); a missing score reaches none."""
    low, high = float("-inf"), float("inf")
    value = F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(low)), F.lit(low))
    cut = Bucketizer(splits=[low, *edges, high], inputCol="_score", outputCol="_bucket")
    return cut.transform(df.withColumn("_score", value)).withColumn(out, F.col("_bucket").cast("int")).drop(
        "_score", "_bucket"
    )


def score_edges(df: DataFrame, score: str, ranges: int | None = None) -> list[float]:
    """Score values that cut the rows into about equal parts of `RANGE_SCORES` different scores."""
    if ranges is None:
        ranges = max(16, -(-df.agg(F.approx_count_distinct(score)).first()[0] // RANGE_SCORES))
    steps = [i / ranges for i in range(1, ranges)]
    finite = F.when(~F.isnan(score) & (F.abs(F.col(score)) < float("inf")), F.col(score).cast("double"))
    found = df.agg(F.percentile_approx(finite, steps, max(10_000, 10 * ranges))).first()[0]
    return sorted(set(found or [0.5]))


def score_ladder(
    df: DataFrame, y: str = "y", score: str = "p", by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """One row per distinct score: pos, neg, and tp, fp = positives, negatives at or above it.

    Also carries the group totals `positives` and `negatives`.
    """
    by = list(by)
    df = df.withColumn(score, F.when(~F.isnan(score), F.col(score)))  # a score that is no number ranks last, as a missing one
    edges = score_edges(df, score, ranges)
    per_score = (
        bucketize(df, score, edges, "_range")
        .groupBy(*by, "_range", F.col(score).alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )
    per_range = per_score.groupBy(*by, "_range").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    group = W.partitionBy(*by)
    above = group.orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)
    shifts = per_range.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_range").alias("_at"),
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_pos_above"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_neg_above"),
        F.sum("_p").over(group).alias("positives"),
        F.sum("_n").over(group).alias("negatives"),
    )
    same = F.col("_range") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = W.partitionBy(*by, "_range").orderBy(F.desc("score"))
    return per_score.join(shifts, same).select(
        *by, "score", "pos", "neg",
        (F.sum("pos").over(inside) + F.col("_pos_above")).alias("tp"),
        (F.sum("neg").over(inside) + F.col("_neg_above")).alias("fp"),
        "positives", "negatives",
    )


def ranking_areas(ladder: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC with ties counted half, and average precision; NULL where one class is absent."""
    wide = "decimal(38,0)"
    doubled = F.col("pos").cast("decimal(19,0)") * (
        2 * (F.col("negatives") - F.col("fp")) + F.col("neg")
    ).cast("decimal(19,0)")
    step = F.col("pos") / F.col("positives") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    sums = ladder.groupBy(*by).agg(
        F.sum(doubled.cast(wide)).cast("double").alias("_pairs"),
        F.sum(F.when(F.col("positives") > 0, step)).alias("pr_auc"),
        F.max("positives").alias("positives"),
        F.max("negatives").alias("negatives"),
    )
    every = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2.0
    return sums.select(
        *by, "positives", "negatives",
        F.when(every > 0, F.col("_pairs") / every).alias("roc_auc"),
        F.when(F.col("positives") > 0, F.col("pr_auc")).alias("pr_auc"),
    )


def roc_points(ladder: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score used as threshold."""
    return ladder.select(
        *by, F.col("score").alias("threshold"),
        F.when(F.col("negatives") > 0, F.col("fp") / F.col("negatives")).alias("fpr"),
        F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).alias("tpr"),
    )
