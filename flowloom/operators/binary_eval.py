"""Binary confusion counts, threshold sweeps and per-group detection rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.contracts import threshold_grid
from flowloom.functions import at_least, ratio
from flowloom.operators.ranking import bucketize, ranking_areas, score_ladder

MANUAL_SOURCE = "manual_fp_optimized"


def confusion(df: DataFrame, threshold: float, y: str = "y", score: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp in one scan."""
    hit = at_least(F.col(score), threshold)
    pos, neg = F.col(y) == 1, F.col(y) == 0
    return df.groupBy(*by).agg(
        F.count_if(neg & ~hit).alias("tn"), F.count_if(neg & hit).alias("fp"),
        F.count_if(pos & ~hit).alias("fn"), F.count_if(pos & hit).alias("tp"),
    )


def metric_columns() -> dict[str, Column]:
    """Metrics over tn, fp, fn, tp; every ratio is 0 where its base is empty."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": ratio(tn, tn + fp),
        "fpr": ratio(fp, fp + tn),
        "fp_pct_benign": ratio(100 * fp, fp + tn),
    }


def binary_metrics(
    df: DataFrame, threshold: float, y: str = "y", score: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and the metrics derived from them, one row per group."""
    counts = confusion(df, threshold, y, score, by).withColumn("threshold", F.lit(float(threshold)))
    return counts.withColumns(metric_columns())


def full_metrics(df: DataFrame, threshold: float, y: str = "y", score: str = "p") -> DataFrame:
    """Threshold metrics plus the threshold-free areas."""
    areas = ranking_areas(score_ladder(df, y, score)).select("roc_auc", "pr_auc")
    row = binary_metrics(df, threshold, y, score)
    return row.withColumns(
        {"roc_auc": areas.select("roc_auc").scalar(), "pr_auc": areas.select("pr_auc").scalar()}
    )


def manual_threshold(df: DataFrame, threshold: float, y: str = "y", score: str = "p") -> DataFrame:
    return full_metrics(df, threshold, y, score).withColumn("source", F.lit(MANUAL_SOURCE))


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float] | None = None, y: str = "y", score: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Metrics at every threshold from one scan.

    Each score is placed on the grid once; a group then has one count pair per
    grid step, and every threshold adds up the steps at or above it.
    """
    grid = list(thresholds or threshold_grid())
    steps = (
        bucketize(df, score, grid, "_step")
        .groupBy(*by, "_step")
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )
    cells = steps.groupBy(*by).agg(
        F.collect_list(F.struct("_step", "pos", "neg")).alias("_cells"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("_neg"),
    )
    rows = cells.select("*", F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("_i", "threshold"))

    def reached(field):
        return F.aggregate(
            "_cells", F.lit(0).cast("long"), lambda s, x: s + F.when(x["_step"] > F.col("_i"), x[field]).otherwise(0)
        )

    rows = rows.withColumns({"tp": reached("pos"), "fp": reached("neg")})
    rows = rows.withColumns({"fn": F.col("_pos") - F.col("tp"), "tn": F.col("_neg") - F.col("fp")})
    return rows.select(*by, "threshold", "tn", "fp", "fn", "tp").withColumns(metric_columns())


def best_threshold(sweep: DataFrame, metric: str = "f1", by: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest metric; the metric is compared at six places, the lowest threshold wins ties."""
    pick = F.struct(F.round(metric, 6).alias("m"), (-F.col("threshold")).alias("t"))
    best = sweep.groupBy(*by).agg(F.max(pick).alias("_b"))
    return best.select(*by, F.round(-F.col("_b.t"), 4).alias("best_threshold"), F.col("_b.m").alias(metric))


def threshold_table(df: DataFrame, y: str = "y", score: str = "p") -> DataFrame:
    """The coarse table 0.05, 0.10 ... 0.95 with false alarms and misses."""
    grid = [round(t, 2) for t in threshold_grid(step=0.05)]
    sweep = threshold_sweep(df, grid, y, score)
    return sweep.select(
        "threshold", "accuracy", "precision", "recall", "f1",
        F.col("fp").alias("fp_count"), F.col("fp_pct_benign").alias("fp_pct"), F.col("fn").alias("fn_count"),
    )


def per_family(
    df: DataFrame, threshold: float, family: str = "family", y: str = "y", score: str = "p"
) -> DataFrame:
    """Accuracy per family; recall for pure attack families, specificity for pure benign ones."""
    rows = confusion(df, threshold, y, score, [family])
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return rows.select(
        family, n.alias("row_count"), (F.col("tn") + F.col("tp")).alias("correct"),
        ratio(F.col("tn") + F.col("tp"), n).alias("accuracy"),
        F.when(F.col("tn") + F.col("fp") == 0, ratio(F.col("tp"), n)).alias("recall"),
        F.when(F.col("fn") + F.col("tp") == 0, ratio(F.col("tn"), n)).alias("specificity"),
    )


def per_label_detection(
    df: DataFrame, threshold: float, benign_value: str, label: str = "raw_label", score: str = "p", floor: float = 0.7
) -> DataFrame:
    """Found and missed rows per raw label; `weak` marks a rate under the floor."""
    counts = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(at_least(F.col(score), threshold)).alias("_hit")
    )
    benign = F.col(label).eqNullSafe(F.lit(benign_value))
    found = F.when(benign, F.col("total") - F.col("_hit")).otherwise(F.col("_hit"))
    return (
        counts.withColumn("detected", found)
        .withColumn("missed", F.col("total") - F.col("detected"))
        .withColumn("rate", ratio(F.col("detected"), F.col("total")))
        .withColumn("metric_type", F.when(benign, "Specificity").otherwise("Recall"))
        .withColumn("weak", (F.col("rate") < floor).cast("int"))
        .drop("_hit")
    )


COMPARED = ["threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def metrics_long(metrics: DataFrame, model: str = "model", names: Sequence[str] = COMPARED) -> DataFrame:
    """One row per model and metric from one row per model."""
    return metrics.unpivot(model, [n for n in names if n in metrics.columns], "metric", "value")


def model_compare(metrics: DataFrame, models: Sequence[str], model: str = "model") -> DataFrame:
    """Metric rows, one column per model."""
    return metrics_long(metrics, model).groupBy("metric").pivot(model, list(models)).agg(F.first("value"))


def best_model(metrics: DataFrame, metric: str = "f1", model: str = "model") -> DataFrame:
    """Model with the highest metric; the first name wins ties."""
    return metrics.orderBy(F.desc(metric), model).limit(1).select(model, metric)


def metrics_by_model(
    df: DataFrame, thresholds: Mapping[str, float], y: str = "y", score: str = "p", model: str = "model"
) -> DataFrame:
    """Full metric row per model from long scores (model, y, p), each at its own threshold."""
    limit = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])[F.col(model)]
    hit = at_least(F.col(score), limit)
    pos, neg = F.col(y) == 1, F.col(y) == 0
    counts = df.groupBy(model).agg(
        F.count_if(neg & ~hit).alias("tn"), F.count_if(neg & hit).alias("fp"),
        F.count_if(pos & ~hit).alias("fn"), F.count_if(pos & hit).alias("tp"),
    )
    areas = ranking_areas(score_ladder(df, y, score, [model]), [model]).select(model, "roc_auc", "pr_auc")
    return counts.withColumns(metric_columns()).withColumn("threshold", limit).join(areas, model)
