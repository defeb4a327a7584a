"""Decisions on scored rows: verdicts, alerts and the gate-then-classify cascade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.contracts import CLASS_NAMES
from flowloom.functions import alert_level, argmax_index, decide, to_places, verdict_text


def verdicts(df: DataFrame, threshold: float, score: str = "p", keep: Sequence[str] = ()) -> DataFrame:
    """Score at four places, 0/1 prediction and its text, next to pass-through columns."""
    prediction = decide(F.col(score), threshold)
    return df.select(
        *keep, to_places(F.col(score), 4).alias("attack_proba"), prediction.alias("prediction"),
        verdict_text(prediction).alias("verdict"),
    )


def alerts(df: DataFrame, score: str = "p") -> DataFrame:
    return df.withColumn("alert", alert_level(F.col(score)))


def class_name(probabilities: Column, names: Sequence[str] = CLASS_NAMES) -> Column:
    """Name of the most likely class; NULL unless every probability is there."""
    ready = F.forall(probabilities, lambda p: p.isNotNull() & ~F.isnan(p))
    return F.when(ready, F.array(*[F.lit(n) for n in names])[argmax_index(probabilities)])


def cascade(
    df: DataFrame,
    gate_threshold: float,
    gate: str = "p",
    probabilities: str = "probs",
    names: Sequence[str] = CLASS_NAMES,
) -> DataFrame:
    """Rows under the gate threshold are benign; the others take the class model's answer,
    or stay a plain attack where that model had incomplete input."""
    hit = decide(F.col(gate), gate_threshold)
    label = F.when(hit == 0, "Benign").otherwise(F.coalesce(class_name(F.col(probabilities), names), F.lit("Attack")))
    return df.withColumns({"is_attack": hit, "attack_class": label})


def row_weights(df: DataFrame, weights: Sequence[float], class_col: str = "class_id") -> DataFrame:
    """Training weight per row from a literal table of class weights."""
    return df.withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[F.col(class_col)])
