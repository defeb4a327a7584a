import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.functions import argmax_index
from flowloom.operators import boosting


def rows_of(spark, n=1500, noise=0.0, parts=3):
    """Eight classes by two features, a third is noise; some cells are missing."""
    df = spark.range(n).repartition(parts).select(
        F.col("id").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(50)) + 1).cast("double").alias("a b"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9)).cast("double").alias("c"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 7).alias("z"), (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(5)) == 0).alias("held"))
    true = (F.floor((F.col("a b") - 1) / 13) * 2 + (F.col("c") > 4).cast("int")).cast("int")
    wrong = F.pmod(F.xxhash64("key", F.lit(4)), F.lit(1000)) < noise * 1000
    return df.withColumn("y", true).withColumn("seen", F.when(wrong, F.pmod(F.xxhash64("key", F.lit(5)), F.lit(8)).cast("int")).otherwise(true))


FEATURES = ["a b", "c", "z"]


def right(rows, model):
    scored = boosting.score(rows, model).select("y", argmax_index(F.col("probs")).alias("pred"))
    return scored.filter("y = pred").count()


@pytest.mark.parametrize("how", [{"depth": 3}, {"leaves": 8, "at_once": 2}, {"depth": 3, "top_share": 0.3, "rest_share": 0.3, "key": "key"}])
def test_eight_classes_are_learned(spark, how):
    rows = rows_of(spark)
    model = boosting.train(rows, FEATURES, "y", 8, "held", rounds=4, step=0.8, store_every=2, **how)
    assert right(rows, model) == 1500
    assert model.best_round == 4 and model.losses == sorted(model.losses, reverse=True) and len(model.losses) == 5
    share = model.importance()
    assert abs(sum(share.values()) - 1) < 1e-9 and share["z"] < 0.02
    if "leaves" in how:
        assert all(t.feature.count(-1) <= 8 for r in model.rounds for t in r)


def test_patience_stops_at_the_lowest_validation_loss(spark):
    rows = rows_of(spark, noise=0.3)
    model = boosting.train(rows, FEATURES, "seen", 8, "held", rounds=60, patience=3, step=0.8, depth=3)
    assert model.best_round == int(np.argmin(model.losses)) < len(model.rounds) == len(model.losses) - 1 == model.best_round + 3
    assert model.train_losses[-1] < model.train_losses[model.best_round]
    assert right(rows, model) > 1350


def test_continued_training_is_one_training(spark):
    rows = rows_of(spark, 600, noise=0.1)
    settings = dict(features=FEATURES, label="seen", classes=8, held="held", step=0.3, depth=2, patience=50)
    once = boosting.train(rows, rounds=5, store_every=2, **settings)
    first = boosting.train(rows, rounds=2, **settings)
    assert first.best_round == 2
    more = boosting.train(rows, rounds=3, start=boosting.BoostedTrees.from_json(first.to_json()), **settings)
    assert more == once


def test_partitioning_does_not_change_trees(spark):
    rows = rows_of(spark, 800, noise=0.2)
    cuts = boosting.feature_cuts(rows, FEATURES, 64)
    fits = [boosting.train(rows.repartition(n), FEATURES, "seen", 8, rounds=2, depth=3, cuts=cuts) for n in (1, 7)]
    assert fits[0].cuts == cuts and fits[0].rounds and fits[0] == fits[1]


def brute_round(x, y, depth, step, ridge):
    """The first tree of two classes by trying every split of every leaf."""
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))

    def grow(rows, d):
        value = -step * g[rows].sum() / (h[rows].sum() + ridge)
        best = None
        if d < depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    left, rest = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    gain = sum(g[r].sum() ** 2 / (h[r].sum() + ridge) for r in (left, rest)) - g[rows].sum() ** 2 / (h[rows].sum() + ridge)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, left, rest)
        return {int(i): value for i in rows} if best is None else grow(best[1], d + 1) | grow(best[2], d + 1)

    return grow(np.arange(len(y)), 0), np.log((y.sum() + 1) / (len(y) - y.sum() + 1))


def test_a_tree_is_the_best_of_all_splits(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, size=(300, 3)).astype(float)
    y = ((x[:, 0] > 6) ^ (x[:, 1] > 3) ^ (rng.random(300) < 0.2)).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t), i) for i, (r, t) in enumerate(zip(x, y))], "a double, b double, c double, y int, i int")
    model = boosting.train(df, ["a", "b", "c"], "y", rounds=1, depth=3, step=0.3)
    values, prior = brute_round(x, y, 3, 0.3, 1.0)
    got = {r.i: np.log(r.probs[1] / r.probs[0]) for r in boosting.score(df, model).collect()}
    assert all(abs(got[i] - prior - v) < 1e-4 for i, v in values.items())


def test_weights_missing_labels_and_bad_labels(spark):
    df = spark.createDataFrame([(1.0, 0, 1.0), (2.0, 1, 9.0), (2.0, 0, 1.0), (None, 1, 1.0), (3.0, None, 1.0), (3.0, 1, -1.0), (1.0, 1, None)], "x double, y int, w double")
    model = boosting.train(df, ["x"], "y", weight="w", rounds=3, depth=2, step=1.0)
    got = [r.probs[1] for r in boosting.score(df.filter("x = 2"), model).collect()]
    assert min(got) > 0.7 and boosting.score(df.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="labels"):
        boosting.train(df.withColumn("y", F.lit(2)), ["x"], "y")
