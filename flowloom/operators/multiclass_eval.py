"""Multiclass confusion matrix and the reports that follow from its K x K cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.contracts import CLASS_NAMES
from flowloom.functions import ratio


def confusion_cells(df: DataFrame, classes: int, y: str = "y", pred: str = "pred") -> DataFrame:
    """All K x K cells, zeros included; one aggregate over the rows.

    A label or prediction that is missing or outside 0..K-1 is NULL; such cells are there only if
    they have rows. They count as wrong answers: a missing prediction lowers its class's recall,
    a missing label the precision of what was predicted, both the accuracy.
    """
    def known(c: str):
        return F.when(F.col(c).between(0, classes - 1), F.col(c).cast("int"))

    counts = df.groupBy(known(y).alias("y"), known(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    zeros = df.sparkSession.range(classes * classes).select(
        F.floor(F.col("id") / classes).cast("int").alias("y"), (F.col("id") % classes).cast("int").alias("pred"), F.lit(0).cast("long").alias("n"))
    return zeros.unionByName(counts).groupBy("y", "pred").agg(F.sum("n").alias("n"))


def normalised(cells: DataFrame) -> DataFrame:
    """Cells as share of their row: the recall view of the matrix."""
    row = F.sum("n").over(W.partitionBy("y"))
    return cells.select("y", "pred", "n", (F.col("n") / (row + F.lit(1e-9))).alias("share"))


def per_class(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1, support of every class; 0 where undefined. Class NULL, if there, holds what is missing."""
    right = F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("s"), none.alias("p"), right.alias("h")),
        F.struct(F.col("pred").alias("c"), none.alias("s"), F.col("n").alias("p"), none.alias("h")),
    )
    sums = cells.select(F.inline(sides)).groupBy(F.col("c").alias("class_id")).agg(
        F.sum("h").alias("hits"), F.sum("p").alias("predicted"), F.sum("s").alias("support")
    )
    return sums.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("predicted")),
            "recall": ratio(F.col("hits"), F.col("support")),
            "f1": ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")),
        }
    )


def summary(classes: DataFrame) -> DataFrame:
    """Accuracy, macro and weighted F1. The macro mean covers the labels seen in truth or
    prediction only; `labels` lists them, since figures over different label sets do not compare."""
    seen = (F.col("support") + F.col("predicted") > 0) & F.col("class_id").isNotNull()
    total = F.sum("support")
    return classes.agg(
        ratio(F.sum("hits"), total).alias("accuracy"),
        F.avg(F.when(seen, F.col("f1"))).alias("macro_f1"),
        ratio(F.sum(F.col("f1") * F.col("support")), total).alias("weighted_f1"),
        F.count_if(seen).alias("label_count"),
        F.array_join(F.array_sort(F.collect_set(F.when(seen, F.col("class_id")))), ",").alias("labels"),
    )


def class_report(classes: DataFrame, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """Rows per seen class plus accuracy, macro average and weighted average."""
    title = F.array(*[F.lit(n) for n in names])[F.col("class_id")]
    counted = classes.where("support + predicted > 0")
    seen = counted.where("class_id IS NOT NULL")
    metrics = ["precision", "recall", "f1"]
    total = F.sum("support")
    rows = seen.select(title.alias("row"), *metrics, "support")
    rates = ratio(F.sum("hits"), total)
    accuracy = counted.agg(F.lit("accuracy").alias("row"), *[rates.alias(m) for m in metrics], total.alias("support"))
    macro = seen.agg(F.lit("macro avg").alias("row"), *[F.avg(m).alias(m) for m in metrics], total.alias("support"))
    weighted = counted.agg(
        F.lit("weighted avg").alias("row"),
        *[ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in metrics],
        total.alias("support"),
    )
    return rows.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def version_delta(old: DataFrame, new: DataFrame, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """F1 of two models per class and as macro mean, each macro row with its own label set."""
    title = F.array(*[F.lit(n) for n in names])[F.col("class_id")]
    a = old.select("class_id", F.col("f1").alias("old_f1"), F.col("support").alias("_s1"))
    b = new.select("class_id", F.col("f1").alias("new_f1"), F.col("support").alias("_s2"))
    rows = (
        a.join(b, "class_id")
        .where("_s1 > 0 OR _s2 > 0")
        .select(title.alias("row"), "old_f1", "new_f1", F.lit("").alias("old_labels"), F.lit("").alias("new_labels"))
    )
    first, second = summary(old), summary(new)
    macro = first.select(
        F.lit("macro").alias("row"),
        F.col("macro_f1").alias("old_f1"),
        second.select("macro_f1").scalar().alias("new_f1"),
        F.col("labels").alias("old_labels"),
        second.select("labels").scalar().alias("new_labels"),
    )
    return rows.unionByName(macro).withColumn("delta", F.col("new_f1") - F.col("old_f1"))
