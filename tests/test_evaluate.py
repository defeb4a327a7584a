import random

import pytest
from pyspark.sql import functions as F

from flowloom.contracts import CLASS_NAMES, threshold_grid
from flowloom.operators import audit, binary_eval, decisions, multiclass_eval, ranking

# Published confusion counts of a binary detector and the rounded metrics that follow from them.
GOLDEN_COUNTS = {"tn": 37_596, "fp": 1_299, "fn": 44_564, "tp": 3_891_463}
GOLDEN_METRICS = {"accuracy": 0.988462, "precision": 0.999666, "recall": 0.988678, "f1": 0.994142}


def scored(spark, pairs):
    return spark.createDataFrame([(y, p) for y, p in pairs], "y int, p double")


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(5)
    return [(rng.randint(0, 1), rng.choice([rng.random(), 0.5, round(rng.random(), 2)])) for _ in range(1500)]


def test_metrics_from_published_counts(spark):
    row = spark.createDataFrame([tuple(GOLDEN_COUNTS.values())], "tn long, fp long, fn long, tp long")
    got = row.withColumns(binary_eval.metric_columns()).first()
    assert {k: round(got[k], 6) for k in GOLDEN_METRICS} == GOLDEN_METRICS
    assert round(got.fp_pct_benign, 2) == 3.34


def test_zero_bases_give_zero(spark):
    got = binary_eval.binary_metrics(scored(spark, [(0, 0.1), (0, 0.2)]), 0.5).first()
    assert (got.precision, got.recall, got.f1, got.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_missing_scores_count_as_no_hit(spark):
    got = binary_eval.confusion(scored(spark, [(1, None), (0, float("nan")), (1, 0.9)]), 0.5).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (1, 0, 1, 1)


def brute_auc(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, found, area = sum(y for y, _ in pairs), 0, 0.0
    for t in sorted({p for _, p in pairs}, reverse=True):
        hit = [y for y, p in pairs if p >= t]
        area += (sum(hit) - found) / total * sum(hit) / len(hit)
        found = sum(hit)
    return area


@pytest.mark.parametrize("ranges", [2, 7, 400])
def test_areas_equal_pair_counting(spark, pairs, ranges):
    ladder = ranking.score_ladder(scored(spark, pairs).repartition(3), ranges=ranges)
    got = ranking.ranking_areas(ladder).first()
    assert got.roc_auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert got.pr_auc == pytest.approx(brute_ap(pairs), abs=1e-12)
    points = sorted((r.threshold, r.fpr, r.tpr) for r in ranking.roc_points(ladder).collect())
    assert points[0][1:] == (1.0, 1.0) and len(points) == len({p for _, p in pairs})


@pytest.mark.parametrize("ranges", [None, 1, 4, 50])
def test_scores_that_are_no_number_rank_last(spark, ranges):
    made = [(i % 3 == 0, i / 100) for i in range(60)] + [(True, float("nan"))] * 20 + [(True, None)] * 5
    df = spark.createDataFrame([(int(y), p) for y, p in made], "y int, p double")
    low = [(y, -1.0 if p is None or p != p else p) for y, p in made]
    pairs = [(1 if p > q else 0.5 if p == q else 0) for y, p in low if y for z, q in low if not z]
    got = ranking.ranking_areas(ranking.score_ladder(df, ranges=ranges)).first()
    assert got.roc_auc == pytest.approx(sum(pairs) / len(pairs))


def test_missing_answers_count_as_wrong(spark):
    df = spark.createDataFrame([(0, 0), (0, None), (1, 1), (1, 9), (9, 1), (None, None)], "y int, pred int")
    cells = multiclass_eval.confusion_cells(df, 3)
    assert cells.agg(F.sum("n")).first()[0] == 6 and cells.where("y IS NOT NULL AND pred IS NOT NULL").count() == 9
    classes = multiclass_eval.per_class(cells)
    by = {r.class_id: r for r in classes.collect()}
    assert (by[0].recall, by[0].precision, by[1].recall, by[1].precision, by[1].support) == (0.5, 1.0, 0.5, 0.5, 2)
    assert multiclass_eval.summary(classes).first().accuracy == pytest.approx(2 / 6)
    report = {r.row: r for r in multiclass_eval.class_report(classes).collect()}
    assert report["accuracy"].precision == pytest.approx(2 / 6) and len(report) == 5


def test_hot_score_and_single_class(spark):
    hot = [(i % 2, 0.5) for i in range(3000)] + [(1, 0.9), (0, 0.1)]
    got = ranking.ranking_areas(ranking.score_ladder(scored(spark, hot))).first()
    assert got.roc_auc == pytest.approx(brute_auc(hot), abs=1e-12)
    one = ranking.ranking_areas(ranking.score_ladder(scored(spark, [(1, 0.2), (1, 0.3)]))).first()
    assert one.roc_auc is None and one.pr_auc == 1.0


def test_sweep_equals_separate_passes(spark, pairs):
    df = scored(spark, pairs)
    sweep = {r.threshold: (r.tn, r.fp, r.fn, r.tp) for r in binary_eval.threshold_sweep(df).collect()}
    assert list(sweep) == threshold_grid() and len(sweep) == 91
    for t, cells in sweep.items():
        hit = [(y, p >= t) for y, p in pairs]
        assert cells == tuple(sum(1 for y, h in hit if (y, h) == k) for k in ((0, False), (0, True), (1, False), (1, True)))


def test_grid_spacing_matches_published_threshold():
    assert threshold_grid()[36] == 0.4100000000000001
    assert [round(t, 2) for t in threshold_grid(step=0.05)] == [round(0.05 * i, 2) for i in range(1, 20)]


def test_first_threshold_wins_ties(spark):
    sweep = binary_eval.threshold_sweep(scored(spark, [(1, 0.9), (0, 0.01)]))
    assert binary_eval.best_threshold(sweep).first().best_threshold == 0.05


def test_family_rates(spark):
    rows = [("a", 1, 0.9), ("a", 1, 0.1), ("b", 0, 0.1), ("m", 0, 0.1), ("m", 1, 0.9)]
    df = spark.createDataFrame(rows, "family string, y int, p double")
    got = {r.family: (r.accuracy, r.recall, r.specificity) for r in binary_eval.per_family(df, 0.5).collect()}
    assert got == {"a": (0.5, 0.5, None), "b": (1.0, None, 1.0), "m": (1.0, None, None)}


def test_macro_average_covers_seen_labels_only(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (2, 2)], "y int, pred int")
    classes = multiclass_eval.per_class(multiclass_eval.confusion_cells(df, 8))
    got = multiclass_eval.summary(classes).first()
    f1 = [2 / 3, 2 / 3, 1.0]
    assert got.macro_f1 == pytest.approx(sum(f1) / 3) and got.label_count == 3 and got.labels == "0,1,2"
    assert got.weighted_f1 == pytest.approx((f1[0] + 2 * f1[1] + f1[2]) / 4) and got.accuracy == 0.75
    stray = spark.createDataFrame([(0, 0), (1, 5)], "y int, pred int")
    labels = multiclass_eval.summary(multiclass_eval.per_class(multiclass_eval.confusion_cells(stray, 8))).first()
    assert labels.label_count == 3 and labels.macro_f1 == pytest.approx(1 / 3)
    assert classes.count() == 8
    outside = multiclass_eval.confusion_cells(spark.createDataFrame([(0, 9), (0, 0), (None, 1)], "y int, pred int"), 8)
    assert outside.agg(F.sum("n")).first()[0] == 3 and outside.where("y IS NULL OR pred IS NULL").agg(F.sum("n")).first()[0] == 2
    report = {r.row: r.support for r in multiclass_eval.class_report(classes).collect()}
    assert report["macro avg"] == 4 and set(report) == {"Benign", "DoS", "DDoS", "accuracy", "macro avg", "weighted avg"}


def test_version_delta_names_label_sets(spark):
    a = multiclass_eval.per_class(multiclass_eval.confusion_cells(spark.createDataFrame([(0, 0), (1, 7)], "y int, pred int"), 8))
    b = multiclass_eval.per_class(multiclass_eval.confusion_cells(spark.createDataFrame([(0, 0), (1, 1)], "y int, pred int"), 8))
    rows = {r.row: r for r in multiclass_eval.version_delta(a, b).collect()}
    assert set(rows) == {"Benign", "DoS", "macro"}
    assert (rows["macro"].old_labels, rows["macro"].new_labels) == ("0,1,7", "0,1")
    assert rows["DoS"].delta == 1.0 and rows["macro"].new_f1 == 1.0


def test_models_side_by_side(spark):
    rows = [("m1", 1, 0.9), ("m1", 0, 0.2), ("m2", 1, 0.1), ("m2", 0, 0.2)]
    df = spark.createDataFrame(rows, "model string, y int, p double")
    metrics = binary_eval.metrics_by_model(df, {"m1": 0.5, "m2": 0.15})
    table = {r.metric: (r.m1, r.m2) for r in binary_eval.model_compare(metrics, ["m1", "m2"]).collect()}
    assert table["roc_auc"] == (1.0, 0.0) and table["threshold"] == (0.5, 0.15)
    assert binary_eval.best_model(metrics).first().model == "m1"
    checks = {r.check: r.status for r in audit.metric_floor(metrics).collect()}
    assert checks == {"m1 f1 > 0.5": "PASS", "m2 f1 > 0.5": "FAIL"}


def test_cascade_and_alerts(spark):
    rows = [(0.69, [0.0] * 7 + [1.0]), (0.70, [0.1, 0.7, 0.7] + [0.0] * 5), (0.9, None), (0.8, [None] + [0.1] * 7)]
    df = spark.createDataFrame(rows, "p double, probs array<double>")
    got = [(r.is_attack, r.attack_class) for r in decisions.cascade(df, 0.7).collect()]
    assert got == [(0, "Benign"), (1, "DoS"), (1, "Attack"), (1, "Attack")]
    assert [r.alert for r in decisions.alerts(df).collect()] == ["normal", "warning", "anomaly", "warning"]
    rows = [tuple(r) for r in decisions.verdicts(df, 0.7).collect()]
    assert rows[0] == (0.69, 0, "BENIGN") and rows[1] == (0.7, 1, "ATTACK")


def test_artefacts_are_looked_up_by_path_or_uri(spark, tmp_path):
    (tmp_path / "a file.json").write_text("{}")
    paths = {"plain": tmp_path / "a file.json", "uri": f"file://{tmp_path}/a file.json", "none": tmp_path / "x"}
    got = {r.check: r.status for r in audit.artefact_checks(spark, paths).collect()}
    assert got == {"exists: plain": "PASS", "exists: uri": "PASS", "exists: none": "FAIL"}


def test_audit_finds_problems(spark):
    rows = [("train", "f", "Bot", 1), ("val", "f", "Bot", 1), ("train", "g", "Benign", 0), ("test", "h", "Benign", 0)]
    df = spark.createDataFrame(rows, "split string, source_relative_file string, source_class_folder string, target_binary int")
    assert [r[0] for r in audit.split_overlap(df).collect()] == ["f"]
    status = {r.check: r.status for r in audit.overlap_checks(df).collect()}
    assert status == {"no file overlap train-val": "FAIL", "no file overlap train-test": "PASS", "no file overlap val-test": "PASS"}
    assert audit.balance_check(df).first().status == "PASS"
    assert {r.check: r.status for r in audit.coverage_checks(df, ["Bot"]).collect()} == {
        "Bot absent from val": "FAIL", "Bot absent from test": "PASS",
    }
    checks = audit.audit(audit.overlap_checks(df), audit.contract_checks(spark, ["a", "a"]))
    assert audit.audit_summary(checks).first().asDict() == {"total_checks": 6, "passed": 4, "failed": 2, "all_passed": 0}
    with pytest.raises(audit.AuditError):
        audit.enforce(checks)
    good = audit.contract_checks(spark, CLASS_NAMES)
    assert audit.enforce(good).count() == 3
    uneven = audit.schema_checks({"train": df, "val": df.drop("split")}, ["split"])
    assert uneven.where(F.col("status") == "FAIL").count() == 2
