"""One callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.contracts import CLASS_NAMES, CLASS_WEIGHTS, FEATURES_46, RENAMES_2018
from flowloom.functions import argmax_index, decide, named, string_hash
from flowloom.operators import (
    audit,
    binary_eval,
    boosting,
    cleaning,
    conversion,
    decisions,
    labels,
    manifest,
    models,
    multiclass_eval,
    packets,
    quotas,
    ranking,
    sampling,
    schema,
    shift,
)
from flowloom.plans import jobs
from flowloom.session import new_table_path, settle
from flowloom.sources import flow_csv
from flowloom.streaming.flow_state import stream_all_features
from flowloom.streaming.live import run_available, stream_flows
from workload import proxies
from workload.proxies import FEATURES, LABEL_TAXONOMIES, VECTOR_FEATURES

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

GAP_SECONDS = 1800
FOREIGN_FEATURES = [
    "Flow Duration", "Total Fwd Packet", "Total Bwd packets", "Total Length of Fwd Packet",
    "Total Length of Bwd Packet", "CWR Flag Count", "Flow Bytes/s", "Flow IAT Mean",
]


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _doubles(df: DataFrame, columns) -> DataFrame:
    """float32 results as double, which both engines print alike."""
    return df.withColumns({c: named(c).cast("double") for c in columns})


def _rounded(df: DataFrame, columns, places: int = 6) -> DataFrame:
    """Real-valued sums at fixed places: their last bits depend on the order of addition."""
    scale = F.lit(float(10**places))
    return df.withColumns({c: F.round(named(c) * scale) / scale for c in columns})


# ---- ingest and alignment -------------------------------------------------


@query
def class_rollup(spark, sf_dir):
    stats = manifest.file_stats(proxies.flows(spark, sf_dir))
    inventory = stats.select(
        "source_class_folder", F.round(F.col("rows") * 640 / 1048576, 2).alias("size_mb"),
        (F.col("source_file_name") == "Brand#3").alias("known_headerless"),
        (F.col("source_file_name") == "Brand#7").alias("suspicious"),
    )
    return flow_csv.class_rollup(inventory)


@query
def align_schema(spark, sf_dir):
    return schema.align(proxies.flows(spark, sf_dir), ["row_key", "Flow Bytes/s", "Idle Mean", "Flow Duration"])


@query
def align_rename(spark, sf_dir):
    foreign = proxies.foreign_flows(spark, sf_dir)
    return _doubles(schema.align_foreign(foreign, RENAMES_2018, FOREIGN_FEATURES, ["row_key"]), FOREIGN_FEATURES)


@query
def safe_numeric(spark, sf_dir):
    numbers = schema.to_numeric(proxies.raw_flows(spark, sf_dir), exclude=["row_key"])
    return _doubles(numbers, ["Flow Duration", "Flow Bytes/s"])


@query
def stamp_target(spark, sf_dir):
    rows = proxies.flows(spark, sf_dir).select("row_key", "source_class_folder", F.lit("x").alias("Src IP"))
    stamped = schema.drop_identity(schema.stamp(rows, "proxy"))
    return stamped.withColumn("target_binary", F.col("target_binary").cast("int"))


@query
def compact_manifest(spark, sf_dir):
    return flow_csv.compact_manifest(proxies.flows(spark, sf_dir), ["DoS/Brand#3", "Recon\\Brand#4"])


@query
def compact_class_totals(spark, sf_dir):
    return flow_csv.class_totals(flow_csv.compact_manifest(proxies.flows(spark, sf_dir)))


@query
def augment_union(spark, sf_dir):
    return schema.union_all(proxies.domain(spark, sf_dir, "a"), proxies.domain(spark, sf_dir, "b"))


# ---- labels ----------------------------------------------------------------


def _dim(spark):
    return labels.taxonomy_table(spark, LABEL_TAXONOMIES)


@query
def label_map(spark, sf_dir):
    return labels.map_labels(proxies.raw_labels(spark, sf_dir), _dim(spark), "first").select("row_key", "class_id")


@query
def unknown_labels(spark, sf_dir):
    return labels.unknown_labels(proxies.raw_labels(spark, sf_dir), _dim(spark), "first")


@query
def binary_target(spark, sf_dir):
    orders = proxies.table(spark, sf_dir, "orders")
    label = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority"))
    return orders.select("o_orderkey", labels.attack_flag(label, "5-LOW").alias("y"))


@query
def class_distribution(spark, sf_dir):
    known = labels.known_rows(proxies.raw_labels(spark, sf_dir), _dim(spark), "first")
    return labels.class_distribution(known, labels.class_table(spark))


@query
def label_freq(spark, sf_dir):
    return labels.label_frequency(proxies.raw_labels(spark, sf_dir))


@query
def taxonomy_diff(spark, sf_dir):
    """Rows that the choice of taxonomy would put into another class."""
    from flowloom.functions import squeeze_label

    counts = proxies.raw_labels(spark, sf_dir).groupBy(squeeze_label(F.col("label")).alias("label"))
    differing = labels.taxonomy_differences(_dim(spark), "first", "second")
    return counts.agg(F.count(F.lit(1)).alias("row_count")).join(differing, "label")


# ---- splits, quotas, samples ------------------------------------------------


def _stats(spark, sf_dir):
    return manifest.file_stats(proxies.flows(spark, sf_dir))


@query
def file_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query
def split_benign(spark, sf_dir):
    return manifest.split_benign(_stats(spark, sf_dir)).select("source_relative_file", "rows", "split")


@query
def split_attack(spark, sf_dir):
    return manifest.split_attack(_stats(spark, sf_dir)).select("source_relative_file", "rows", "split")


@query
def split_manifest(spark, sf_dir):
    return manifest.split_manifest(_stats(spark, sf_dir))


@query
def quota_largest_remainder(spark, sf_dir):
    stats = settle(_stats(spark, sf_dir), "stats")
    budget = stats.agg(F.floor(F.sum("rows") / 3)).scalar()
    return quotas.largest_remainder(stats, "rows", budget, "source_relative_file").select(
        "source_relative_file", "rows", "quota"
    )


@query
def quota_family_balanced(spark, sf_dir):
    attack = settle(_stats(spark, sf_dir).where("target_binary = 1"), "stats")
    target = attack.agg(F.floor(F.sum("rows") / 2)).scalar()
    return quotas.family_balanced(attack, target).select("source_relative_file", "rows", "train_attack_quota")


@query
def train_attack_quota(spark, sf_dir):
    stats = settle(_stats(spark, sf_dir), "stats")
    return quotas.train_attack_quotas(manifest.split_manifest(stats)).select(
        "source_relative_file", "rows", "split", "train_attack_quota"
    )


@query
def exact_file_sample(spark, sf_dir):
    rows = proxies.flows(spark, sf_dir).select("row_key", "source_relative_file")
    counts = rows.groupBy("source_relative_file").agg(F.count(F.lit(1)).alias("total_rows"))
    targets = counts.withColumn("want", F.floor(F.col("total_rows") / 3))
    return sampling.take_exact(rows, targets, ["source_relative_file"])


def _split_rows(spark, sf_dir):
    rows = proxies.flows(spark, sf_dir).select(
        "row_key", "source_relative_file", "source_file_name", "source_class_folder", "target_binary"
    )
    return jobs.balanced_split(rows).rows


@query
def split_rows(spark, sf_dir):
    return _split_rows(spark, sf_dir).select("row_key", "source_relative_file", "split")


@query
def split_stats(spark, sf_dir):
    return sampling.split_stats(_split_rows(spark, sf_dir))


@query
def train_only_classes(spark, sf_dir):
    stats = settle(_stats(spark, sf_dir), "stats")
    return manifest.train_only_classes(manifest.split_manifest(stats))


def _class_rows(spark, sf_dir):
    known = labels.known_rows(proxies.raw_labels(spark, sf_dir), _dim(spark), "first")
    return known.select("row_key", "class_id")


@query
def stratified_split(spark, sf_dir):
    rows = _class_rows(spark, sf_dir)
    sizes = sampling.split_sizes(sampling.class_counts(rows, "class_id"), "class_id")
    return sampling.stratified_split(rows, sizes, "class_id")


@query
def class_cap(spark, sf_dir):
    caps = {0: 500, 1: 1_000_000, 2: 800}
    return jobs.augment(_class_rows(spark, sf_dir), [], "class_id", caps)


@query
def shuffle_rows(spark, sf_dir):
    return sampling.shuffled(proxies.flows(spark, sf_dir).select("row_key", "source_class_folder"))


@query
def sample_n(spark, sf_dir):
    return sampling.sample_n(proxies.flows(spark, sf_dir).select("row_key"), 5000)


@query
def sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(proxies.flows(spark, sf_dir).select("row_key"), 0.2)


@query
def stable_hash(spark, sf_dir):
    return proxies.flows(spark, sf_dir).select("row_key", string_hash(F.col("row_key")).alias("hash"))


# ---- cleaning ----------------------------------------------------------------


@query
def inf_nan_report(spark, sf_dir):
    return cleaning.inf_nan_report(proxies.flows(spark, sf_dir), FEATURES)


@query
def inf_nan_summary(spark, sf_dir):
    return cleaning.inf_nan_summary(proxies.flows(spark, sf_dir), FEATURES)


@query
def replace_inf(spark, sf_dir):
    return cleaning.drop_infinite(proxies.flows(spark, sf_dir), FEATURES).select("row_key", *map(named, FEATURES))


@query
def fit_fill_median(spark, sf_dir):
    return cleaning.fill_table(spark, cleaning.fit_fill(proxies.flows(spark, sf_dir), [*FEATURES, "Idle Mean"]))


@query
def fit_fill_mean(spark, sf_dir):
    fills = cleaning.fit_fill(proxies.flows(spark, sf_dir), [*FEATURES, "Idle Mean"], "mean")
    return _rounded(cleaning.fill_table(spark, fills), ["fill"], 3)


def _cleaned(spark, sf_dir):
    rows = proxies.flows(spark, sf_dir)
    return cleaning.inference_clean(rows, FEATURES, cleaning.fit_fill(rows, FEATURES), ["row_key"])


@query
def apply_fill(spark, sf_dir):
    rows = proxies.flows(spark, sf_dir).select("row_key", *map(named, FEATURES))
    return cleaning.apply_fill(rows, cleaning.fit_fill(rows, FEATURES))


@query
def inference_clean(spark, sf_dir):
    return _cleaned(spark, sf_dir)


@query
def residual_missing(spark, sf_dir):
    return cleaning.dirty_counts(_cleaned(spark, sf_dir), FEATURES)


@query
def scaler_fit(spark, sf_dir):
    return _rounded(cleaning.fit_scaler(proxies.flows(spark, sf_dir), FEATURES), ["mean", "std"], 3)


@query
def scaler_apply(spark, sf_dir):
    rows = proxies.flows(spark, sf_dir).select("row_key", *map(named, FEATURES))
    clean = cleaning.drop_infinite(rows, FEATURES)
    return _rounded(cleaning.apply_scaler(clean, cleaning.fit_scaler(clean, FEATURES)), FEATURES)


@query
def xy_rejoin(spark, sf_dir):
    x, y = cleaning.split_xy(proxies.flows(spark, sf_dir), FEATURES)
    return cleaning.rejoin_xy(x, y).select("row_key", named("Flow Duration"), "source_class_folder", "target_binary")


@query
def constant_features(spark, sf_dir):
    return cleaning.constant_features(proxies.flows(spark, sf_dir), FEATURES)


@query
def feature_convert(spark, sf_dir):
    return _doubles(conversion.to_46_features(proxies.foreign_flows(spark, sf_dir), ("row_key",)), FEATURES_46)


@query
def zero_clean(spark, sf_dir):
    return _doubles(conversion.prepare_2018(proxies.foreign_flows(spark, sf_dir), ("row_key",)), FEATURES_46)


@query
def extend_training(spark, sf_dir):
    """Benign flows as the base set, the attack labels of the 2018 vocabulary added and capped."""
    foreign = proxies.foreign_flows(spark, sf_dir)
    dim = labels.taxonomy_table(spark)
    benign = labels.known_rows(foreign.where("Label = 'Benign'"), dim, "extended46", "Label")
    base = conversion.prepare_2018(benign, ("row_key", "class_id"))
    caps = {0: 5000, 1: 3000, 2: 1_000_000, 3: 2000, 6: 200}
    built = jobs.extend_training_set(base, foreign.where("Label <> 'Benign'"), dim, "extended46", caps)
    return _doubles(built.select("row_key", "class_id", "Rate", named("Tot sum"), "Magnitue"), ["Rate", "Tot sum", "Magnitue"])


@query
def feature_stats(spark, sf_dir):
    return _rounded(cleaning.feature_stats(proxies.flows(spark, sf_dir), FEATURES), ["mean", "std"], 3)


# ---- packets -------------------------------------------------------------------

_REAL = [
    f"{side} {name}" for side in ("Fwd", "Bwd")
    for name in ("Packet Length Mean", "Packet Length Std", "Packets/s", "IAT Mean", "Segment Size Avg")
] + ["Flow Bytes/s", "Flow Packets/s", "Flow IAT Mean", "Packet Length Mean", "Packet Length Std",
     "Packet Length Variance", "Average Packet Size", "Down/Up Ratio"]


def _flow_rows(found):
    rounded = _rounded(found, [*_REAL, "Flow IAT Std", "Fwd IAT Std", "Bwd IAT Std", "Idle Mean", "Idle Std", "Active Mean", "Active Std"], 3)
    return rounded.withColumn("flow_start", F.unix_micros("flow_start"))


@query
def packets_to_flows(spark, sf_dir):
    return _flow_rows(packets.packets_to_flows(proxies.event_packets(spark, sf_dir), GAP_SECONDS))


@query
def packets_to_flows_busy(spark, sf_dir):
    """Nearly all packets belong to one endpoint pair, which is cut into slices of at most 1,000 packets."""
    return _flow_rows(packets.packets_to_flows(proxies.busy_packets(spark, sf_dir), 600, slice_rows=1_000))


@query
def packets_to_flows_stream(spark, sf_dir):
    """The events file as a stream: flows finished by the watermark of ten minutes."""
    source = proxies.table(spark, sf_dir, "events").schema
    stream = stream_flows(proxies.event_packet_stream(spark, sf_dir, source), GAP_SECONDS, "10 minutes")
    out = new_table_path(spark, "flow-stream")
    run_available(stream, f"{out}/rows", f"{out}/state").awaitTermination()
    found = _rounded(spark.read.schema(stream.schema).parquet(f"{out}/rows"), _REAL, 3)
    return found.withColumn("flow_start", F.unix_micros("flow_start"))


@query
def packets_to_flows_stream_all(spark, sf_dir):
    """The events file as a stream, with every feature: flows finished by the watermark of ten minutes."""
    source = proxies.table(spark, sf_dir, "events").schema
    stream = stream_all_features(proxies.event_packet_stream(spark, sf_dir, source), GAP_SECONDS, "10 minutes")
    out = new_table_path(spark, "flow-stream")
    run_available(stream, f"{out}/rows", f"{out}/state").awaitTermination()
    return _flow_rows(spark.read.schema(stream.schema).parquet(f"{out}/rows").where("late_packets = 0").drop("late_packets"))


# ---- decisions on given scores ---------------------------------------------------


@query
def threshold_decide(spark, sf_dir):
    return proxies.scored2(spark, sf_dir).select("row_key", "p", decide(F.col("p"), 0.7).alias("prediction"))


@query
def argmax_class(spark, sf_dir):
    return proxies.scored_k(spark, sf_dir).select("row_key", argmax_index(F.col("probs")).alias("pred"))


@query
def alert_level(spark, sf_dir):
    return decisions.alerts(proxies.scored2(spark, sf_dir).select("row_key", "p"))


@query
def verdict(spark, sf_dir):
    return decisions.verdicts(proxies.scored2(spark, sf_dir), 0.7, "p_b", ["row_key", "family"])


@query
def cascade(spark, sf_dir):
    return decisions.cascade(proxies.scored2(spark, sf_dir), 0.7).select("row_key", "is_attack", "attack_class")


@query
def cascade_fallback(spark, sf_dir):
    decided = decisions.cascade(proxies.scored2(spark, sf_dir), 0.7)
    return decided.groupBy("is_attack", "attack_class").agg(F.count(F.lit(1)).alias("row_count"))


@query
def class_weights(spark, sf_dir):
    return decisions.row_weights(_class_rows(spark, sf_dir), CLASS_WEIGHTS["iot46"])


# ---- evaluation --------------------------------------------------------------------


@query
def binary_confusion(spark, sf_dir):
    return binary_eval.confusion(proxies.scored2(spark, sf_dir), 0.5)


@query
def binary_metrics(spark, sf_dir):
    return binary_eval.binary_metrics(proxies.scored_models(spark, sf_dir), 0.5, by=["model"])


@query
def roc_auc(spark, sf_dir):
    ladder = ranking.score_ladder(proxies.scored_models(spark, sf_dir), by=["model"])
    return ranking.ranking_areas(ladder, ["model"]).select("model", "positives", "negatives", "roc_auc")


@query
def average_precision(spark, sf_dir):
    ladder = ranking.score_ladder(proxies.scored_models(spark, sf_dir), by=["model"])
    return _rounded(ranking.ranking_areas(ladder, ["model"]).select("model", "pr_auc"), ["pr_auc"], 9)


@query
def roc_points(spark, sf_dir):
    return ranking.roc_points(ranking.score_ladder(proxies.scored_models(spark, sf_dir), by=["model"]), ["model"])


@query
def threshold_grid(spark, sf_dir):
    return binary_eval.threshold_sweep(proxies.scored_models(spark, sf_dir), by=["model"]).select(
        "model", "threshold", "tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1"
    )


@query
def best_threshold(spark, sf_dir):
    sweep = binary_eval.threshold_sweep(proxies.scored_models(spark, sf_dir), by=["model"])
    return binary_eval.best_threshold(sweep, by=["model"])


@query
def threshold_table(spark, sf_dir):
    return binary_eval.threshold_table(proxies.scored2(spark, sf_dir), score="p_b")


@query
def manual_threshold(spark, sf_dir):
    return _rounded(binary_eval.manual_threshold(proxies.scored2(spark, sf_dir), 0.7), ["pr_auc"], 9)


@query
def per_family(spark, sf_dir):
    return binary_eval.per_family(proxies.scored2(spark, sf_dir), 0.5)


@query
def per_label_detection(spark, sf_dir):
    return binary_eval.per_label_detection(proxies.scored2(spark, sf_dir), 0.3, "Benign")


def _model_metrics(spark, sf_dir):
    return binary_eval.metrics_by_model(proxies.scored_models(spark, sf_dir), {"p": 0.7, "p_b": 0.41})


@query
def model_compare(spark, sf_dir):
    return _rounded(binary_eval.model_compare(_model_metrics(spark, sf_dir), ["p", "p_b"]), ["p", "p_b"], 9)


@query
def best_model(spark, sf_dir):
    return binary_eval.best_model(binary_eval.binary_metrics(proxies.scored_models(spark, sf_dir), 0.5, by=["model"]))


def _cells(spark, sf_dir, pred="pred"):
    return multiclass_eval.confusion_cells(proxies.scored_k(spark, sf_dir), 8, pred=pred)


@query
def confusion_multi(spark, sf_dir):
    return _cells(spark, sf_dir)


@query
def confusion_norm(spark, sf_dir):
    return multiclass_eval.normalised(_cells(spark, sf_dir))


@query
def per_class_prf(spark, sf_dir):
    return multiclass_eval.per_class(_cells(spark, sf_dir))


@query
def multi_summary(spark, sf_dir):
    found = multiclass_eval.summary(multiclass_eval.per_class(_cells(spark, sf_dir)))
    return _rounded(found, ["macro_f1", "weighted_f1"], 9)


@query
def class_report(spark, sf_dir):
    found = multiclass_eval.class_report(multiclass_eval.per_class(_cells(spark, sf_dir)))
    return _rounded(found, ["precision", "recall", "f1"], 9)


@query
def version_delta(spark, sf_dir):
    old = multiclass_eval.per_class(_cells(spark, sf_dir))
    new = multiclass_eval.per_class(_cells(spark, sf_dir, "pred_b"))
    return _rounded(multiclass_eval.version_delta(old, new), ["old_f1", "new_f1", "delta"], 9)


_FOREIGN_FILLS = {f: 1.5 for f in FOREIGN_FEATURES}


def _cross(spark, sf_dir):
    return jobs.cross_dataset(
        proxies.foreign_flows(spark, sf_dir), RENAMES_2018, FOREIGN_FEATURES, _FOREIGN_FILLS,
        F.col("given_score"), 0.7, "Label", "Benign", ["given_score"],
    )


@query
def cross_dataset_eval(spark, sf_dir):
    return _cross(spark, sf_dir)[0]


@query
def cross_dataset_labels(spark, sf_dir):
    return _cross(spark, sf_dir)[1]


def _shift(spark, sf_dir):
    return shift.domain_shift(proxies.domain(spark, sf_dir, "a"), proxies.domain(spark, sf_dir, "b"), FEATURES)


@query
def domain_shift(spark, sf_dir):
    return _rounded(_shift(spark, sf_dir), ["base_median", "other_median", "ratio", "base_p95", "other_p95"], 4)


@query
def shift_severity(spark, sf_dir):
    return shift.shift_severity(_shift(spark, sf_dir)).select("feature", "severity", "counted")


@query
def top_features(spark, sf_dir):
    stats = cleaning.feature_stats(proxies.flows(spark, sf_dir), FEATURES)
    return shift.top_features(stats.select("feature", F.col("max").alias("importance")), 3)


# ---- audit ------------------------------------------------------------------------------


@query
def split_overlap(spark, sf_dir):
    rows = proxies.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("source_relative_file"),
        F.when(F.col("o_custkey") % 3 == 0, "train").when(F.col("o_orderkey") % 2 == 0, "val").otherwise("test").alias("split"),
    )
    return audit.split_overlap(rows)


def _audited(spark, sf_dir):
    split = settle(jobs.balanced_split(proxies.flows(spark, sf_dir)).rows, "split")
    return jobs.clean_splits(split, FEATURES).rows


@query
def audit_overlap(spark, sf_dir):
    return audit.overlap_checks(_split_rows(spark, sf_dir))


@query
def audit_clean(spark, sf_dir):
    return audit.clean_checks(audit.split_facts(_audited(spark, sf_dir), FEATURES))


@query
def audit_balance(spark, sf_dir):
    return audit.balance_check(_split_rows(spark, sf_dir))


@query
def audit_coverage(spark, sf_dir):
    return audit.coverage_checks(_split_rows(spark, sf_dir), ["Mirai", "Recon"])


@query
def audit_dirty(spark, sf_dir):
    """Every row check on flows as they come, not cleaned, with the brand as the split: failures with their counts."""
    split = F.when(F.col("source_file_name") == "Brand#11", "train").when(F.col("source_file_name") == "Brand#12", "val").otherwise("test")
    facts = settle(audit.split_facts(proxies.flows(spark, sf_dir).withColumn("split", split), FEATURES), "split-facts")
    return audit.audit(audit.overlap_checks(facts), audit.clean_checks(facts), audit.balance_check(facts), audit.coverage_checks(facts, ["Mirai", "DoS"]))


@query
def audit_metric_floor(spark, sf_dir):
    metrics = binary_eval.binary_metrics(proxies.scored_models(spark, sf_dir), 0.1, by=["model"])
    return audit.metric_floor(metrics).select("check", "status")


@query
def audit_summary(spark, sf_dir):
    return audit.audit_summary(jobs.audit_split(_audited(spark, sf_dir), FEATURES, ["Mirai", "Recon"]))


# ---- learners (row counts and schema only: no SQL counterpart) ------------------------------


def _vector_split(spark, sf_dir):
    rows = proxies.vectors(spark, sf_dir)
    return [rows.where(F.col("split") == s) for s in ("train", "val", "test")]


_SMALL_BOOST = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.2}
_SMALL_FOREST = {"numTrees": 10, "maxDepth": 4}


@query
def train_boosted(spark, sf_dir):
    train, val, test = _vector_split(spark, sf_dir)
    model = models.train_boosted(train, val, VECTOR_FEATURES, **_SMALL_BOOST)
    return models.score_binary(test, model).select("row_key", "y", "p")


@query
def train_forest(spark, sf_dir):
    train, _, test = _vector_split(spark, sf_dir)
    model = models.train_forest(train, VECTOR_FEATURES, **_SMALL_FOREST)
    return models.score_binary(test, model).select("row_key", "y", "p")


@query
def train_multiclass(spark, sf_dir):
    train, _, test = _vector_split(spark, sf_dir)
    weighted = decisions.row_weights(train, CLASS_WEIGHTS["flow71"])
    model = models.train_forest(weighted, VECTOR_FEATURES, "class_id", "weight", **_SMALL_FOREST)
    scored = models.score_classes(test, model).withColumn("pred", argmax_index(F.col("probs")))
    return multiclass_eval.per_class(multiclass_eval.confusion_cells(scored, 8, y="class_id"))


@query
def feature_importance(spark, sf_dir):
    train, _, _ = _vector_split(spark, sf_dir)
    return models.feature_importance(models.train_forest(train, VECTOR_FEATURES, **_SMALL_FOREST), spark, 20)


@query
def cascade_models(spark, sf_dir):
    train, _, test = _vector_split(spark, sf_dir)
    gate = models.train_forest(train, VECTOR_FEATURES, **_SMALL_FOREST)
    classes = models.train_forest(train, VECTOR_FEATURES, "class_id", **_SMALL_FOREST)
    return models.cascade_score(test, gate, classes, 0.5, CLASS_NAMES).select("row_key", "p", "attack_class")


@query
def train_and_judge(spark, sf_dir):
    rows = proxies.vectors(spark, sf_dir)
    return jobs.train_and_judge(rows, VECTOR_FEATURES, "y", **_SMALL_BOOST).metrics


# ---- learners on rules that trees reproduce: checked against SQL ------------------------------


def ruled_flows(spark, sf_dir, join=None):
    """All flows with a binary and a three-class label that follow from one feature; the others are noise."""
    rows = cleaning.zero_clean(proxies.flows(spark, sf_dir, join), FEATURES[:4])
    split = F.when(F.pmod(F.xxhash64("row_key"), F.lit(10)) < 7, "train").when(F.pmod(F.xxhash64("row_key"), F.lit(10)) < 8, "val").otherwise("test")
    duration = F.col(FEATURES[0])
    return rows.select(
        "row_key", *FEATURES[:4], split.alias("split"), (duration > 25).cast("int").alias("y"),
        F.when(duration <= 15, 0).when(duration <= 35, 1).otherwise(2).alias("class_id"))


_RULE_TREES = {"maxDepth": 3, "maxBins": 64}


@query
def learned_rule(spark, sf_dir):
    """Boosted trees on the training rows, stopped on the validation rows, predict every row."""
    rows = ruled_flows(spark, sf_dir)
    model = models.train_boosted(rows.where("split = 'train'"), rows.where("split = 'val'"), FEATURES[:4], maxIter=4, **_RULE_TREES)
    return models.score_binary(rows, model).select("row_key", decide(F.col("p"), 0.5).alias("prediction"))


def _class_forest(rows):
    return models.train_forest(rows.where("split = 'train'"), FEATURES[:4], "class_id", numTrees=5, featureSubsetStrategy="all", **_RULE_TREES)


@query
def learned_classes(spark, sf_dir):
    rows = ruled_flows(spark, sf_dir)
    return models.score_classes(rows, _class_forest(rows)).select("row_key", argmax_index(F.col("probs")).alias("pred"))


@query
def learned_confusion(spark, sf_dir):
    rows = ruled_flows(spark, sf_dir)
    scored = models.score_classes(rows, _class_forest(rows)).withColumn("pred", argmax_index(F.col("probs")))
    return multiclass_eval.confusion_cells(scored, 3, y="class_id")


@query
def learned_top_feature(spark, sf_dir):
    return models.feature_importance(_class_forest(ruled_flows(spark, sf_dir)), spark, 1).select("feature")


# ---- boosting grown on Spark, with validation and patience ----------------------------------


def _boost_rows(spark, sf_dir):
    """All flows with rules of two and of eight classes; `noisy` is the binary rule with one label in five turned over."""
    rows = ruled_flows(spark, sf_dir)
    turned = F.pmod(F.xxhash64("row_key", F.lit("noise")), F.lit(5)) == 0
    return settle(rows.withColumns({
        "held": F.col("split") == "val", "class8": F.floor((F.col(FEATURES[0]) - 1) / 7).cast("int"),
        "noisy": F.when(turned, 1 - F.col("y")).otherwise(F.col("y"))}), "boost-fixture")


@query
def boosted_classes(spark, sf_dir):
    """Eight classes by softmax boosting on the training rows, judged on the validation rows; every row is predicted."""
    rows = _boost_rows(spark, sf_dir)
    fit_on = decisions.row_weights(rows.where("split <> 'test'").withColumn("class_id", F.col("class8")), CLASS_WEIGHTS["flow71"])
    model = boosting.train(fit_on, FEATURES[:4], "class8", 8, "held", "weight", rounds=5, step=0.6, depth=3)
    return boosting.score(rows, model).select("row_key", argmax_index(F.col("probs")).alias("pred"))


@query
def boosted_stopped(spark, sf_dir):
    """Noisy labels: rounds end `patience` after the lowest validation loss, whose round is the one used."""
    rows = _boost_rows(spark, sf_dir)
    model = boosting.train(rows.where("split <> 'test'"), FEATURES[:4], "noisy", held="held", rounds=500, patience=4, step=0.8, depth=3, least_rows=100)
    told = boosting.score(rows, model).select("row_key", decide(F.col("probs")[1], 0.5).alias("prediction"))
    lowest = model.losses.index(min(model.losses)) == model.best_round
    return told.withColumns({
        "uses_lowest_loss": F.lit(lowest), "ended_by_patience": F.lit(len(model.rounds) == model.best_round + 4 and len(model.rounds) < 500)})


@query
def boosted_leafwise(spark, sf_dir):
    """Trees by leaf on drawn rows, continued from a first ensemble."""
    rows = _boost_rows(spark, sf_dir)
    how = {"held": "held", "leaves": 6, "at_once": 2, "top_share": 0.3, "rest_share": 0.3, "key": "row_key", "step": 0.5}
    first = boosting.train(rows.where("split <> 'test'"), FEATURES[:4], "y", rounds=2, **how)
    model = boosting.train(rows.where("split <> 'test'"), FEATURES[:4], "y", rounds=3, start=first, **how)
    return boosting.score(rows, model).select("row_key", decide(F.col("probs")[1], 0.5).alias("prediction"))


@query
def boosted_importance(spark, sf_dir):
    rows = _boost_rows(spark, sf_dir).where("split = 'train'")
    share = boosting.train(rows, FEATURES[:4], "class8", 8, rounds=2, depth=3).importance()
    top = max(share, key=share.get)
    return rows.groupBy().agg(F.lit(top).alias("feature"), F.count("*").alias("_n")).where("_n > 0").drop("_n")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, split without leaks, balance: rows of each family per split."""
    split = settle(jobs.balanced_split(proxies.flows(spark, sf_dir)).rows, "split")
    prepared = jobs.clean_splits(split, FEATURES)
    return sampling.split_stats(prepared.rows)
