import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.contracts import ATTACK_TARGETS, BENIGN_TARGETS
from flowloom.functions import string_hash
from flowloom.operators import labels, manifest, quotas, sampling
from flowloom.plans import jobs

relaxed = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def stats_of(spark, files):
    rows = [(f"{fam}/{name}", name, fam, int(fam != "Benign"), n) for fam, name, n in files]
    return spark.createDataFrame(
        rows,
        "source_relative_file string, source_file_name string, source_class_folder string, target_binary int, rows long",
    )


def by_file(df):
    return {r.source_relative_file: r.split for r in df.collect()}


def test_benign_seeds_and_error(spark):
    three = stats_of(spark, [("Benign", x, n) for x, n in zip("abc", (30, 20, 10))])
    assert by_file(manifest.split_benign(three)) == {"Benign/a": "train", "Benign/b": "val", "Benign/c": "test"}
    four = stats_of(spark, [("Benign", x, n) for x, n in zip("abcd", (10, 10, 10, 10))])
    assert by_file(manifest.split_benign(four)) == {
        "Benign/a": "train", "Benign/b": "train", "Benign/c": "val", "Benign/d": "test",
    }
    with pytest.raises(Exception, match="too few"):
        manifest.split_benign(stats_of(spark, [("Benign", "a", 1), ("Benign", "b", 1)])).collect()


def test_attack_families_by_size(spark):
    files = [("One", "a", 5), ("Two", "a", 5), ("Two", "b", 9), ("Many", "a", 60), ("Many", "b", 20), ("Many", "c", 15), ("Many", "d", 1)]
    got = by_file(manifest.split_attack(stats_of(spark, files)))
    assert got["One/a"] == "train" and got["Two/b"] == "train" and got["Two/a"] == "test"
    assert (got["Many/a"], got["Many/b"], got["Many/c"], got["Many/d"]) == ("train", "val", "test", "train")


def test_fill_goes_to_emptiest_split():
    sizes = [50, 30, 20, 10, 10, 5]
    got = list(manifest._fill(sizes, ["train", "val", "test"], ATTACK_TARGETS))
    assert got == ["train", "val", "test", "train", "train", "train"]
    zero = list(manifest._fill([0, 0, 0], [], BENIGN_TARGETS))
    assert zero == ["train", "train", "train"]


def largest_remainder(caps, budget):
    total = sum(caps.values())
    budget = max(0, min(budget, total))
    raw = {k: budget * c / total if total else 0.0 for k, c in caps.items()}
    got = {k: min(int(raw[k]), caps[k]) for k in caps}
    left = budget - sum(got.values())
    for k in sorted(caps, key=lambda k: (-(raw[k] - got[k]), k)):
        if left > 0 and got[k] < caps[k]:
            got[k] += 1
            left -= 1
    return got


@relaxed
@given(st.lists(st.integers(0, 500), min_size=1, max_size=12), st.integers(-5, 3000))
def test_quota_matches_loop_and_sums_up(spark, caps, budget):
    table = {f"f{i:02d}": c for i, c in enumerate(caps)}
    df = spark.createDataFrame(list(table.items()), "k string, cap long")
    got = {r.k: r.quota for r in quotas.largest_remainder(df, "cap", F.lit(budget), "k").collect()}
    assert got == largest_remainder(table, budget)
    assert sum(got.values()) == max(0, min(budget, sum(caps))) and all(got[k] <= table[k] for k in table)


def test_quota_survives_huge_tables(spark):
    df = spark.createDataFrame([("a", 400_000_000_000), ("b", 600_000_000_000)], "k string, cap long")
    got = {r.k: r.quota for r in quotas.largest_remainder(df, "cap", F.lit(500_000_000_001), "k").collect()}
    assert sum(got.values()) == 500_000_000_001


def test_family_balance_small_family_gives_all(spark):
    df = stats_of(spark, [("A", "1", 1000), ("B", "1", 30), ("C", "1", 300), ("C", "2", 700)])
    got = {r.source_relative_file: r.train_attack_quota for r in quotas.family_balanced(df, F.lit(900)).collect()}
    assert got["B/1"] == 30 and sum(got.values()) == 900
    assert got["A/1"] == got["C/1"] + got["C/2"]


def test_quota_target_and_policy(spark):
    files = [("Benign", x, 101) for x in "abcd"] + [("DoS", x, 500) for x in "abcd"]
    m = manifest.split_manifest(stats_of(spark, files))
    got = quotas.train_attack_quotas(m, 0.5).agg(F.sum("train_attack_quota")).first()[0]
    assert got == 101  # 202 benign rows in train, half of them
    with pytest.raises(ValueError):
        quotas.train_attack_quotas(m, 1.0, "other")


def ranked(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("range_rows", [1, 16, 4096])
@pytest.mark.parametrize("parts", [1, 7])
def test_sample_equals_full_ranking(spark, range_rows, parts):
    groups = {"hot": [f"h{i}" for i in range(3000)], "mid": [f"m{i}" for i in range(200)], "one": ["o"], "none": ["x", "y"]}
    want = {"hot": 1234, "mid": 200, "one": 1, "none": 0}
    rows = spark.createDataFrame([(g, k) for g, ks in groups.items() for k in ks], "g string, row_key string")
    targets = spark.createDataFrame([(g, len(groups[g]), n) for g, n in want.items()], "g string, total_rows long, want long")
    got = sampling.take_exact(rows.repartition(parts), targets, ["g"], range_rows=range_rows)
    kept = {}
    for r in got.collect():
        kept.setdefault(r.g, set()).add(r.row_key)
    for g, n in want.items():
        assert kept.get(g, set()) == set(ranked(groups[g])[:n])
    assert sampling.sample_shortfall(got, targets, ["g"]).isEmpty()


def test_shortfall_is_reported(spark):
    rows = spark.createDataFrame([("a", "1")], "g string, row_key string")
    targets = spark.createDataFrame([("a", 5, 3)], "g string, total_rows long, want long")
    assert sampling.sample_shortfall(rows, targets, ["g"]).first().asDict() == {"g": "a", "expected": 3, "taken": 1}


def test_stratified_sizes_match_known_rounding(spark):
    counts = spark.createDataFrame([(0, 700), (1, 201), (2, 99)], "c int, total_rows long")
    sizes = sampling.split_sizes(counts, "c").collect()
    assert [sum(r[n] for r in sizes) for n in ("n_train", "n_val", "n_test")] == [700, 150, 150]
    assert all(abs(r.n_test - r.total_rows * 0.15) <= 1 and abs(r.n_val - r.total_rows * 0.15) <= 1 for r in sizes)


def test_stratified_split_is_a_partition(spark):
    keys = [(i % 3 if i % 5 else 0, f"k{i}") for i in range(2000)]
    rows = spark.createDataFrame(keys, "c int, row_key string")
    sizes = sampling.split_sizes(sampling.class_counts(rows, "c"), "c")
    split = sampling.stratified_split(rows, sizes, "c", range_rows=8)
    assert split.count() == 2000 and split.select("row_key").distinct().count() == 2000
    wanted = {(r.c, s): r[f"n_{s}"] for r in sizes.collect() for s in ("train", "val", "test")}
    assert {(r.c, r.split): r["count"] for r in split.groupBy("c", "split").count().collect()} == wanted


def test_cap_keeps_classes_without_cap(spark):
    rows = spark.createDataFrame([(i % 3, f"k{i}") for i in range(300)], "c int, row_key string")
    counts = {r.c: r["count"] for r in jobs.augment(rows, [], "c", {0: 10, 1: 1000}).groupBy("c").count().collect()}
    assert counts == {0: 10, 1: 100, 2: 100}


@pytest.mark.parametrize("bad", [("a", None), (None, "k1")])
def test_missing_group_or_key_is_an_error(spark, bad):
    rows = spark.createDataFrame([("a", f"k{i}") for i in range(9)] + [bad], "g string, row_key string")
    targets = spark.createDataFrame([("a", 9, 3)], "g string, total_rows long, want long")
    with pytest.raises(Exception, match="is NULL"):
        sampling.take_exact(rows, targets, ["g"]).collect()


def test_repeated_keys_at_the_cut_and_short_groups_are_errors(spark):
    targets = spark.createDataFrame([("a", 30, 15)], "g string, total_rows long, want long")
    same = spark.createDataFrame([("a", "k")] * 30, "g string, row_key string")
    with pytest.raises(Exception, match="not unique"):
        sampling.take_exact(same, targets, ["g"]).collect()
    few = spark.createDataFrame([("a", f"k{i}") for i in range(5)], "g string, row_key string")
    with pytest.raises(Exception, match="fewer rows"):
        sampling.take_exact(few, targets, ["g"]).collect()


@pytest.mark.parametrize("range_rows", [1, 7, 10_000])
def test_one_file_with_most_rows_and_no_broadcast(spark, range_rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = {"big": [f"b{i}" for i in range(900)], "small": [f"s{i}" for i in range(100)]}
        rows = spark.createDataFrame([(g, k) for g, ks in keys.items() for k in ks], "g string, row_key string")
        targets = spark.createDataFrame([("big", 900, 333), ("small", 100, 20)], "g string, total_rows long, want long")
        got = sampling.take_exact(rows, targets, ["g"], range_rows=range_rows).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for g, n in (("big", 333), ("small", 20)):
        assert sorted(r.row_key for r in got if r.g == g) == sorted(ranked(keys[g])[:n])


def test_sample_size_edges(spark):
    rows = spark.range(50).select(F.col("id").cast("string").alias("row_key"))
    assert sampling.sample_n(rows, 500).count() == 50
    assert sampling.sample_n(rows, 0).count() == 0
    assert sampling.sample_fraction(rows, 0.25).count() == 12  # 12.5 rounds to the even number


@pytest.mark.parametrize("range_rows", [1, 100, 4096])
def test_whole_table_sample_equals_full_ranking(spark, range_rows):
    keys = [f"k{i}" for i in range(1000)]
    rows = spark.createDataFrame([(k,) for k in keys], "row_key string").repartition(3)
    got = sampling.sample_n(rows, 321, range_rows=range_rows)
    assert sorted(r.row_key for r in got.collect()) == sorted(ranked(keys)[:321])


def test_balanced_split_keeps_other_splits_whole(spark):
    rng = random.Random(1)
    rows = [
        (f"{fam}-{f}-{i}", f"{fam}/{f}", f, fam, int(fam != "Benign"))
        for fam, files, n in (("Benign", 5, 40), ("DoS", 4, 300), ("Bot", 1, 20))
        for f in map(str, range(files))
        for i in range(n + rng.randint(0, 9))
    ]
    df = spark.createDataFrame(
        rows,
        "row_key string, source_relative_file string, source_file_name string, source_class_folder string, target_binary int",
    )
    split = jobs.balanced_split(df, range_rows=16)
    full = {r.source_relative_file: r for r in split.manifest.collect()}
    kept = {r.source_relative_file: r["count"] for r in split.rows.groupBy("source_relative_file").count().collect()}
    for f, m in full.items():
        cut = m.split == "train" and m.target_binary == 1
        assert kept.get(f, 0) == (m.train_attack_quota if cut else m.rows)
    stats = sampling.split_stats(split.rows).where("split = 'train'").agg(F.sum("benign"), F.sum("attack")).first()
    assert stats[0] == stats[1]
    assert {r[0] for r in manifest.train_only_classes(split.rows).collect()} == {"Bot"}


def test_string_hash(spark):
    def loop(text):
        v = 0
        for ch in text:
            v = (v * 131 + ord(ch)) % (2**32 - 1)
        return v

    texts = ["", "a", "Benign/Brand#1", "Дос", "x" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", string_hash(F.col("t")).alias("h"))
    assert {r.t: r.h for r in df.collect()} == {t: loop(t) for t in texts}


def test_labels_normalise_and_account(spark):
    dim = labels.taxonomy_table(spark)
    df = spark.createDataFrame([("  DoS Hulk\t",), ("BENIGN",), ("odd",), ("odd",), (None,)], "label string")
    got = labels.map_labels(df, dim, "flow71")
    assert {r.label: r.class_id for r in got.collect()} == {"  DoS Hulk\t": 1, "BENIGN": 0, "odd": None, None: None}
    assert {r.label: r.row_count for r in labels.unknown_labels(df, dim, "flow71").collect()} == {"odd": 2, None: 1}
    diff = {r.label: (r.first_class, r.second_class) for r in labels.taxonomy_differences(dim, "flow71", "extended46").collect()}
    assert diff["brute force -web"] == (5, 4) and diff["infilteration"] == (None, 3) and "bot" not in diff
    flags = df.select("label", labels.attack_flag(F.col("label"), "BENIGN").alias("y")).collect()
    assert [r.y for r in flags] == [1, 0, 1, 1, 1]
