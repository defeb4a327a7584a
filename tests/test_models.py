from concurrent.futures import ThreadPoolExecutor
import pytest
from pyspark.sql import functions as F

from flowloom.operators import models
from flowloom.plans import jobs
from flowloom.streaming.live import read_growing_csv, run_available, stream_verdicts

FEATURES = ["Flow Bytes/s", "x"]


@pytest.fixture(scope="module")
def rows(spark):
    made = [(f"k{i}", ["train", "val", "test"][i % 5 // 2], float(i % 7), float((i * 37) % 11), int(i % 7 > 3), i % 3) for i in range(600)]
    return spark.createDataFrame(made, "row_key string, split string, `Flow Bytes/s` double, x double, y int, class_id int").cache()


@pytest.fixture(scope="module")
def forest(rows):
    return models.train_forest(rows, FEATURES, "y", numTrees=5, maxDepth=3)


def test_boosting_stops_on_validation_rows(rows):
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    model = models.train_boosted(train, val, FEATURES, maxIter=4, maxDepth=2)
    assert 1 <= model.stages[-1].getNumTrees <= 4
    scored = models.score_binary(rows, model)
    assert scored.columns == [*rows.columns, "p"]
    assert scored.where((F.col("p") >= 0.5) == (F.col("y") == 1)).count() == 600


def test_boosting_ends_at_the_round_of_least_validation_loss(spark):
    import random

    rng = random.Random(4)
    made = [(float(rng.randrange(20)), float(rng.randrange(20)), i % 3 == 0) for i in range(400)]
    noisy = spark.createDataFrame([(a, b, int((a > 9) != (rng.random() < 0.3)), v) for a, b, v in made], "`Flow Bytes/s` double, x double, y int, v boolean")
    train, val = noisy.where("NOT v"), noisy.where("v")
    every = models.train_boosted(train, val.limit(0), FEATURES, maxIter=12, maxDepth=3, stepSize=0.5)
    losses = models.validation_losses(every, val)
    assert len(losses) == 12
    best = models.train_boosted(train, val, FEATURES, maxIter=12, maxDepth=3, stepSize=0.5, first_rounds=4, patience=20)
    assert best.stages[-1].getNumTrees == losses.index(min(losses)) + 1
    eager = models.train_boosted(train, val, FEATURES, maxIter=12, maxDepth=3, stepSize=0.5, first_rounds=4, patience=0)
    assert eager.stages[-1].getNumTrees == losses[:4].index(min(losses[:4])) + 1


def test_training_job_picks_threshold_and_metrics(rows):
    done = jobs.train_and_judge(rows.withColumn("flat", F.lit(1.0)), [*FEATURES, "flat"], "y", maxIter=2, maxDepth=2)
    assert done.features == FEATURES and 0.05 <= done.threshold <= 0.95
    assert {r.split: r.f1 for r in done.metrics.collect()} == {"val": 1.0, "test": 1.0}


def test_importance_is_sorted(spark, forest):
    got = [(r.feature, r.importance) for r in models.feature_importance(forest, spark).collect()]
    assert got[0][0] == "Flow Bytes/s" and got[0][1] > got[1][1]
    assert models.feature_importance(forest, spark, 1).count() == 1


def test_cascade_sends_only_gated_complete_rows(spark, rows, forest):
    classes = models.train_forest(rows, ["x"], "class_id", numTrees=3, maxDepth=3)
    mixed = rows.withColumn("x", F.when(F.col("row_key") != "k5", F.col("x")))
    gate = models.train_forest(rows, ["Flow Bytes/s"], "y", numTrees=5, maxDepth=3)
    got = models.cascade_score(mixed, gate, classes, 0.5)
    assert got.count() == 600
    assert {r[0] for r in got.where("y = 0").select("attack_class").distinct().collect()} == {"Benign"}
    assert got.where("row_key = 'k5'").first().attack_class == "Attack"
    assert got.where("y = 1 AND row_key <> 'k5' AND attack_class NOT IN ('Benign', 'DoS', 'DDoS')").isEmpty()


def test_registry_round_trip(spark, rows, forest, tmp_path):
    root = str(tmp_path / "registry")
    gate = models.ModelEntry("gate", "1.0", "flow71", "binary", 0.7, True, "classes")
    models.publish(spark, root, gate, forest)
    models.publish(spark, root, models.ModelEntry("classes", "1.0", "flow71", "multiclass"), forest)
    assert {r.id: (r.threshold, r.is_gate, r.cascade_next) for r in models.registry(spark, root).collect()} == {
        "gate": (0.7, True, "classes"), "classes": (0.5, False, None),
    }
    entry, model = models.load_model(spark, root, "gate")
    assert entry == gate
    same = models.score_binary(rows, model).join(models.score_binary(rows, forest).select("row_key", F.col("p").alias("q")), "row_key")
    assert same.where("p <> q").isEmpty()
    assert models.with_threshold(gate, 0.41).threshold == 0.41


def test_versions_are_kept_and_found(spark, rows, forest, tmp_path):
    root = str(tmp_path / "registry")
    models.publish(spark, root, models.ModelEntry("gate", "1.0", "flow71", "binary", 0.7), forest)
    first = models.registry(spark, root).first().published
    with ThreadPoolExecutor(4) as pool:  # publishers side by side
        list(pool.map(lambda i: models.publish(spark, root, models.ModelEntry("gate", f"2.{i}", "flow71", "binary", 0.1 * i), forest), range(4)))
    models.publish(spark, root, models.ModelEntry("gate", "3.0", "flow71", "binary", 0.6), forest)
    assert models.registry(spark, root).count() == 6
    assert models.load_model(spark, root, "gate")[0].version == "3.0"
    assert models.load_model(spark, root, "gate", version="2.3")[0].threshold == pytest.approx(0.3)
    assert models.load_model(spark, root, "gate", as_of=first)[0].version == "1.0"
    with pytest.raises(LookupError):
        models.load_model(spark, root, "gate", version="9")
    half = tmp_path / "registry" / "gate" / "files" / "unfinished"  # a publisher that was killed
    half.mkdir()
    assert models.load_model(spark, root, "gate")[0].version == "3.0"


def test_cascade_follows_the_registry(spark, rows, forest, tmp_path):
    root = str(tmp_path / "registry")
    classes = models.train_forest(rows, ["x"], "class_id", numTrees=3, maxDepth=3)
    models.publish(spark, root, models.ModelEntry("a", "1", "raw", "binary", 0.5, True, "b"), forest)
    models.publish(spark, root, models.ModelEntry("b", "1", "upper", "binary", 0.0, False, "c"), forest)
    models.publish(spark, root, models.ModelEntry("c", "1", "raw", "multiclass"), classes)
    chain = models.cascade_chain(spark, root, "a")
    assert [e.id for e, _ in chain] == ["a", "b", "c"]
    got = models.run_cascade(rows, chain, {"upper": lambda d: d.withColumn("row_key", F.upper("row_key"))})
    want = models.cascade_score(rows, forest, classes, 0.5).select(F.upper("row_key").alias("k"), F.col("attack_class").alias("w"))
    both = got.withColumn("k", F.upper("row_key")).join(want, "k")
    assert both.count() == rows.count() and both.where("attack_class <> w").isEmpty()
    assert {r[0] for r in got.select("decided_by").distinct().collect()} == {"a", "c"}
    assert got.where("decided_by = 'c' AND row_key <> upper(row_key)").isEmpty()
    short = models.run_cascade(rows, chain[:1])
    assert {r[0] for r in short.select("attack_class").distinct().collect()} == {"Benign", "Attack"}
    models.publish(spark, root, models.ModelEntry("c", "2", "raw", "binary", 0.5, False, "a"), forest)
    with pytest.raises(ValueError, match="comes back"):
        models.cascade_chain(spark, root, "a")


def test_thresholds_from_json():
    assert models.parse_threshold('{"threshold": 0.7}') == 0.7
    assert models.parse_threshold('{"best_threshold": 0.41}') == 0.41
    assert models.parse_threshold("0.3") == 0.3 and models.parse_threshold("{}") == 0.5


def test_live_scoring_of_a_growing_folder(spark, forest, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], "row_key string, ` Flow Bytes/s` double, x double").schema
    text = ["row_key, Flow Bytes/s,x\na,Infinity,1\nb,6,2\n", "row_key, Flow Bytes/s,x\nc,,3\n"]
    (tmp_path / "in").mkdir()
    for i, body in enumerate(text):
        (tmp_path / "in" / f"{i}.csv").write_text(body)
        flows = read_growing_csv(spark, folder, schema)
        live = stream_verdicts(flows, forest, FEATURES, {"Flow Bytes/s": 0.0, "x": 0.0}, 0.5, ["row_key"])
        run_available(live, out, state).awaitTermination()
    got = {r.row_key: r.verdict for r in spark.read.parquet(out).collect()}
    assert got == {"a": "BENIGN", "b": "ATTACK", "c": "BENIGN"}


def test_registry_cascade_reads_joined_flows(spark, tmp_path, monkeypatch):
    from workload import file_queries

    parts = spark.range(40).select(F.col("id").alias("p_partkey"), F.format_string("Brand#%d", F.col("id") % 5).alias("p_brand"), F.element_at(F.array(F.lit("STANDARD"), F.lit("PROMO")), (F.col("id") % 2 + 1).cast("int")).alias("p_type"))
    parts.unionByName(parts.where("p_partkey = 7")).write.parquet(str(tmp_path / "part.parquet"))
    n = F.col("id")
    lines = spark.range(900).select(
        F.when(n % 100 != 99, n % 45).alias("l_partkey"), n.alias("l_orderkey"), (n % 10).alias("l_suppkey"), F.lit(1).alias("l_linenumber"), (n * 7 % 50 + 1).cast("double").alias("l_quantity"),
        (n * 1.5 + 1).cast("double").alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.02).alias("l_tax"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    plans, binary = [], file_queries._binary
    monkeypatch.setattr(file_queries, "_binary", lambda rows, *a: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or binary(rows, *a))
    told = file_queries.registry_cascade(spark, str(tmp_path))
    plans.append(told._jdf.queryExecution().executedPlan().toString())
    # the part keys are no table of the driver's, and flows are joined once for all models and branches
    assert len(plans) == 4 and not any("Broadcast" in p or "l_partkey" in p for p in plans)
    joined = file_queries.ruled_flows(spark, str(tmp_path), "merge")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    said = F.when(F.col("l_quantity") <= 25, "gate").when(F.col("l_quantity") <= 40, "second").otherwise("classes")
    want = [(r.l_orderkey, "high" if r.said == "classes" else "Benign", r.said) for r in lines.withColumn("said", said).where("l_partkey < 40").collect() for _ in range(1 + (r.l_partkey == 7))]
    assert sorted((int(r.row_key.split("-")[0]), r.attack_class, r.decided_by) for r in told.collect()) == sorted(want)
