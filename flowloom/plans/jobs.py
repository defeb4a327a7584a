"""End-to-end jobs: balanced split, training with evaluation, cross-dataset evaluation, augmentation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import named
from flowloom.operators import audit, binary_eval, cleaning, models, sampling
from flowloom.operators.conversion import prepare_2018
from flowloom.operators.labels import attack_flag, known_rows
from flowloom.operators.manifest import file_stats, split_manifest
from flowloom.operators.quotas import train_attack_quotas
from flowloom.operators.schema import align_foreign, union_all
from flowloom.session import settle


@dataclass
class Split:
    manifest: DataFrame
    rows: DataFrame


def balanced_split(flows: DataFrame, ratio: float = 1.0, seed: int = 42, **tuning: int) -> Split:
    """File statistics -> manifest -> quotas -> split rows.

    Statistics and manifest are written once: they are small, read several times, and
    their known size lets Spark choose the join. Without the first, each of the
    manifest's two walks would scan the flows anew.
    """
    stats = settle(file_stats(flows), "file-stats")
    manifest = settle(train_attack_quotas(split_manifest(stats), ratio), "manifest")
    return Split(manifest, sampling.sample_files(flows, manifest, seed, **tuning))


@dataclass
class Prepared:
    rows: DataFrame
    fills: dict[str, float]


def clean_splits(rows: DataFrame, features: Sequence[str], strategy: str = "median") -> Prepared:
    """Fill values from the training rows, applied to all splits in one projection.

    Fitting scans the training rows a few times: pass a written split table.
    """
    fills = cleaning.fit_fill(rows.where("split = 'train'"), features, strategy)
    return Prepared(cleaning.clean(rows, features, fills), fills)


@dataclass
class Trained:
    model: PipelineModel
    threshold: float
    metrics: DataFrame
    features: list[str]


def train_and_judge(rows: DataFrame, features: Sequence[str], label: str = "target_binary", **params) -> Trained:
    """Drop constant features, train with early stop, pick the threshold on val, judge val and test."""
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    kept, _ = cleaning.drop_constant(train, features)
    model = models.train_boosted(train, val, kept, label, **params)
    judged = models.score_binary(rows.where("split <> 'train'"), model).drop(*features)
    scored = settle(judged, "scores")  # the model runs once, the reports read its scores several times
    sweep = binary_eval.threshold_sweep(scored.where("split = 'val'"), y=label)
    threshold = binary_eval.best_threshold(sweep).first().best_threshold
    metrics = [
        binary_eval.full_metrics(scored.where(F.col("split") == s), threshold, label).withColumn("split", F.lit(s))
        for s in ("val", "test")
    ]
    return Trained(model, threshold, union_all(*metrics), kept)


def foreign_rows(
    df: DataFrame,
    renames: Mapping[str, str],
    features: Sequence[str],
    fills: Mapping[str, float],
    label_col: str,
    benign_value: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A foreign table in the model's schema, cleaned with training parameters, with y and raw_label."""
    aligned = align_foreign(df, renames, features, keep=[label_col, *keep])
    cleaned = cleaning.inference_clean(aligned, features, fills, keep=[label_col, *keep])
    return cleaned.withColumns(
        {"y": attack_flag(named(label_col), benign_value), "raw_label": named(label_col)}
    )


def cross_dataset(
    df: DataFrame,
    renames: Mapping[str, str],
    features: Sequence[str],
    fills: Mapping[str, float],
    score: PipelineModel | Column,
    threshold: float,
    label_col: str,
    benign_value: str,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Align, clean and score a foreign table; overall metrics and detection per raw label."""
    rows = foreign_rows(df, renames, features, fills, label_col, benign_value, keep)
    if isinstance(score, Column):
        rows = rows.withColumn("p", score)
    else:
        rows = settle(models.score_binary(rows, score).select("y", "raw_label", "p"), "scores")
    return (
        binary_eval.binary_metrics(rows, threshold),
        binary_eval.per_label_detection(rows, threshold, benign_value),
    )


def augment(base: DataFrame, extra: Sequence[DataFrame], class_col: str, caps: Mapping[int, int], seed: int = 42) -> DataFrame:
    """Union of training sets, at most `cap` rows per class."""
    everything = union_all(base, *extra)
    counts = sampling.class_counts(everything, class_col)
    return sampling.take_exact(everything, sampling.cap_targets(counts, caps, class_col), [class_col], seed=seed)


def extend_training_set(
    base: DataFrame,
    foreign: DataFrame,
    dim: DataFrame,
    taxonomy: str,
    caps: Mapping[int, int],
    label_col: str = "Label",
    key: str = "row_key",
    seed: int = 42,
) -> DataFrame:
    """Add a labelled foreign capture to a 46-feature training table (key, class_id, features), capped per class.

    Unknown labels go first, before any feature is computed.
    """
    known = known_rows(foreign, dim, taxonomy, label_col)
    return augment(base, [prepare_2018(known, (key, "class_id"))], "class_id", caps, seed)


def audit_split(rows: DataFrame, features: Sequence[str], absent: Sequence[str]) -> DataFrame:
    """All data checks on a cleaned split table: the rows are read once, checks read the facts of each file."""
    facts = settle(audit.split_facts(rows, features), "split-facts")
    by_split = {s: rows.where(F.col("split") == s) for s in ("train", "val", "test")}
    return audit.audit(
        audit.contract_checks(rows.sparkSession, features),
        audit.schema_checks(by_split, features),
        audit.overlap_checks(facts),
        audit.clean_checks(facts),
        audit.balance_check(facts),
        audit.coverage_checks(facts, absent),
    )
