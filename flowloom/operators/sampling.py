"""Exact, repeatable sampling without replacement.

A row's place is decided by a hash of seed and row key. "The n rows with the
lowest hash" is an exact uniform sample, independent of partitioning. Ranking
whole groups would put a hot file or class into one task, so the cut hash of
every group is found from counts: a histogram of leading hex digits (merged
map-side) shows in which hash range the n-th row lies, the next digits inside
that range follow until it is thin, and only the thin range is ranked. The sample itself is then a plain filter.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.functions import seeded_hash
from flowloom.operators.quotas import largest_remainder
from flowloom.session import settle

SALTS = 64  # parts of a group where its cut table is too large to broadcast
SMALL_ROW_BYTES = 256  # of a row of a cut table
RANGE_ROWS = 4096  # aimed rows per hash range
MAX_DIGITS = 4  # digits of the hash in one round: at most 16**4 counters per group
HASH_DIGITS = 32
BELOW_ALL, ABOVE_ALL = "", "~"  # sort before and after every hex digit


def _lookup(rows: DataFrame, small: DataFrame, group: Sequence[str], key: str, salts: int = SALTS) -> DataFrame:
    """rows join small, which has a written row or two a group.

    A table within the broadcast threshold is joined as it is. Beyond it the join shuffles by group, and a file with most
    of the rows would be one task, whose partitioning later counts would even reuse: each group is dealt over `salts` parts then.
    """
    threshold = rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if small.count() * SMALL_ROW_BYTES <= _bytes(threshold):
        return rows.join(small, list(group))
    part = F.pmod(F.xxhash64(key, F.lit("part")), F.lit(salts)).cast("int")
    dealt = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_part", part).join(dealt, [*group, "_part"]).drop("_part")


def _bytes(setting: str) -> int:
    """A size such as 10485760, 10485760b or 10MB."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)i?b?\s*", setting.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def cut_points(
    rows: DataFrame,
    targets: DataFrame,
    group: Sequence[str],
    key: str = "row_key",
    seed: int = 42,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per target the hash and key of the last row inside its sample.

    `targets` has the group columns, `cut` (its name), `total_rows` of the group
    and `want`. Adds `cut_hash` and `cut_key`; wanting nothing gives a hash below
    every row, wanting all of a group one above every row. Fails on a NULL group or
    key, on a key that repeats at the cut and on a group with fewer rows than
    `total_rows` says, instead of returning a sample of another size.
    """
    tag = [*group, "cut"]
    targets = settle(targets, "cut-targets")
    hashed = _present(rows, [*group, key]).select(*group, F.col(key).alias("cut_key"), seeded_hash(seed, F.col(key)).alias("cut_hash"))
    edge = targets.where("want > 0 AND want < total_rows").select(
        *tag, F.col("want").alias("_need"), F.col("total_rows").alias("_inside"), F.lit("").alias("_prefix"))
    for done in range(0, HASH_DIGITS, MAX_DIGITS):
        wide = edge.where(F.col("_inside") > range_rows)
        if wide.isEmpty():
            break
        inside = _lookup(hashed, wide, group, "cut_key").where(F.col("cut_hash").startswith(F.col("_prefix")))
        counted = inside.groupBy(*tag, "_need", "_prefix", F.substring("cut_hash", done + 1, MAX_DIGITS).alias("_next")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(W.partitionBy(*tag).orderBy("_next"))
        thinner = counted.withColumn("_upto", upto).where("_upto >= _need AND _upto - _n < _need").select(
            *tag, (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"), F.col("_n").alias("_inside"),
            F.concat("_prefix", "_next").alias("_prefix"))
        edge = settle(edge.where(F.col("_inside") <= range_rows).unionByName(thinner), "cut-ranges")
    order = W.partitionBy(*tag).orderBy("cut_hash", "cut_key")
    again = (F.lead("cut_hash").over(order) == F.col("cut_hash")) & (F.lead("cut_key").over(order) == F.col("cut_key"))
    last = (
        _lookup(hashed, edge, group, "cut_key")
        .where(F.col("cut_hash").startswith(F.col("_prefix")))
        .withColumns({"_place": F.row_number().over(order), "_again": again})
        .where("_place = _need")
        .select(*tag, F.when(F.col("_again"), F.raise_error(F.lit(f"{key} is not unique at the cut of a sample"))).otherwise(F.col("cut_hash")).alias("cut_hash"), "cut_key")
    )
    sure = F.when(F.col("want") <= 0, BELOW_ALL).when(F.col("want") >= F.col("total_rows"), ABOVE_ALL)
    short = F.raise_error(F.lit("a group has fewer rows than its target says"))
    cuts = targets.join(last, tag, "left").withColumn("cut_hash", F.coalesce(sure, "cut_hash", short))
    return settle(cuts, "cuts")


def _present(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows; reading one with a NULL in a column that must not have any is an error."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} is NULL")).cast(rows.schema[c].dataType)) for c in columns})


def _inside(seed: int, key: str, cut_hash: Column, cut_key: Column) -> Column:
    h = seeded_hash(seed, F.col(key))
    return (h < cut_hash) | ((h == cut_hash) & (F.col(key) <= cut_key))


def take_exact(
    rows: DataFrame,
    targets: DataFrame,
    group: Sequence[str],
    key: str = "row_key",
    seed: int = 42,
    carry: Sequence[str] = (),
    **tuning: int,
) -> DataFrame:
    """Keep exactly `want` rows of each group; groups without a target are dropped.

    Row keys have to be unique. `targets` holds the group columns, `total_rows`,
    `want` and any columns to `carry` over to the rows.
    """
    cuts = cut_points(rows, targets.withColumn("cut", F.lit(0)), group, key, seed, **tuning)
    limits = cuts.select(*group, *carry, "cut_hash", F.col("cut_key").alias("_cut_key"))
    kept = _lookup(_present(rows, [*group, key]), limits, group, key).where(_inside(seed, key, F.col("cut_hash"), F.col("_cut_key")))
    return kept.select(*rows.columns, *carry)


def sample_shortfall(sample: DataFrame, targets: DataFrame, group: Sequence[str]) -> DataFrame:
    """Groups whose sample differs from the wanted size; empty when all is well."""
    taken = sample.groupBy(*group).agg(F.count(F.lit(1)).alias("taken"))
    expected = F.greatest(F.lit(0), F.least("want", "total_rows"))
    both = targets.select(*group, expected.alias("expected")).join(taken, list(group), "left")
    return both.withColumn("taken", F.coalesce("taken", F.lit(0))).where("taken <> expected")


def sample_files(rows: DataFrame, manifest: DataFrame, seed: int = 42, **tuning: int) -> DataFrame:
    """Rows with their split: training attack files cut to their quota, all others whole."""
    capped = (F.col("split") == "train") & (F.col("target_binary") == 1)
    targets = manifest.select(
        "source_relative_file", "split",
        F.col("rows").alias("total_rows"),
        F.when(capped, F.col("train_attack_quota")).otherwise(F.col("rows")).alias("want"),
    )
    return take_exact(rows, targets, ["source_relative_file"], seed=seed, carry=["split"], **tuning)


def split_stats(df: DataFrame) -> DataFrame:
    """Rows, benign and attack rows per split and class."""
    return df.groupBy("split", "source_class_folder").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("target_binary") == 0).alias("benign"),
        F.count_if(F.col("target_binary") == 1).alias("attack"),
    )


def split_sizes(counts: DataFrame, class_col: str, test_share: float = 0.15, val_share: float = 0.15) -> DataFrame:
    """Rows of each class for train, val and test from a table (class, total_rows).

    The test share is cut first, then the validation share out of the rest;
    totals are rounded up for the smaller part and classes get proportional
    counts by largest remainder.
    """
    n = F.col("total_rows")
    rest_share = val_share / ((1.0 - test_share - val_share) + val_share)
    everything = W.partitionBy()
    total = F.sum(n).over(everything)
    step = counts.withColumn("_budget", total - F.ceil(total * F.lit(test_share)))
    step = largest_remainder(step, "total_rows", F.col("_budget"), class_col, out="_rest")
    rest = F.sum("_rest").over(everything)
    step = step.withColumn("_budget", rest - F.ceil(rest * F.lit(rest_share)))
    step = largest_remainder(step, "_rest", F.col("_budget"), class_col, out="n_train")
    return step.select(
        class_col, "total_rows", "n_train",
        (F.col("_rest") - F.col("n_train")).alias("n_val"), (n - F.col("_rest")).alias("n_test"),
    )


def stratified_split(
    rows: DataFrame, sizes: DataFrame, class_col: str, key: str = "row_key", seed: int = 42, **tuning: int
) -> DataFrame:
    """Add `split`: the lowest hashes of a class are test, the next ones val, the others train."""
    wanted = F.explode(
        F.array(
            F.struct(F.lit("test").alias("cut"), F.col("n_test").alias("want")),
            F.struct(F.lit("val").alias("cut"), (F.col("n_test") + F.col("n_val")).alias("want")),
        )
    )
    targets = sizes.select(class_col, "total_rows", wanted.alias("_t")).select(class_col, "total_rows", "_t.*")
    cuts = cut_points(rows, targets, [class_col], key, seed, **tuning)
    limits = cuts.groupBy(class_col).agg(
        *[
            F.max(F.when(F.col("cut") == name, F.col(c))).alias(f"_{name}_{c}")
            for name in ("test", "val")
            for c in ("cut_hash", "cut_key")
        ]
    )
    def inside(name):
        return _inside(seed, key, F.col(f"_{name}_cut_hash"), F.col(f"_{name}_cut_key"))

    split = F.when(inside("test"), "test").when(inside("val"), "val").otherwise("train")
    return _lookup(_present(rows, [class_col, key]), limits, [class_col], key).select(*rows.columns, split.alias("split"))


def cap_targets(counts: DataFrame, caps: Mapping[int, int], class_col: str) -> DataFrame:
    """Targets for a per-class cap; classes outside the cap table are kept whole."""
    table = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])
    return counts.withColumn("want", F.least(F.col("total_rows"), table[F.col(class_col)]))  # least passes over NULL


def class_counts(rows: DataFrame, class_col: str) -> DataFrame:
    return rows.groupBy(class_col).agg(F.count(F.lit(1)).alias("total_rows"))


def _inside_all(rows: DataFrame, n: int, total: int, key: str, seed: int, range_rows: int) -> Column:
    """Condition for the n lowest hashes of the whole table, as literals.

    Each round counts the next leading digits inside the range found so far, until
    the range is thin enough to look up the last row.
    """
    if n <= 0 or n >= total:
        return F.lit(n >= total)
    hashed = rows.select(F.col(key).alias("k"), seeded_hash(seed, F.col(key)).alias("h"))
    prefix, need, inside = "", n, total
    while inside > range_rows and len(prefix) + MAX_DIGITS <= 32:
        digits = F.substring("h", len(prefix) + 1, MAX_DIGITS).alias("r")
        counts = hashed.where(F.startswith("h", F.lit(prefix))).groupBy(digits).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(W.orderBy("r"))  # at most 16**4 rows
        edge = counts.withColumn("upto", upto).where((F.col("upto") >= need) & (F.col("upto") - F.col("n") < need)).first()
        prefix, need, inside = prefix + edge.r, need - edge.upto + edge.n, edge.n
    last = hashed.where(F.startswith("h", F.lit(prefix))).orderBy("h", "k").offset(need - 1).limit(1).first()
    return _inside(seed, key, F.lit(last.h), F.lit(last.k))


def sample_n(
    rows: DataFrame, n: int, key: str = "row_key", seed: int = 42, range_rows: int = RANGE_ROWS, total: int | None = None
) -> DataFrame:
    """Exactly n rows of the whole table (all of it when it is smaller)."""
    total = rows.count() if total is None else total
    return rows.where(_inside_all(rows, n, total, key, seed, range_rows))


def sample_fraction(
    rows: DataFrame, fraction: float, key: str = "row_key", seed: int = 42, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Exactly round(fraction * rows) rows of the whole table, halves to the even number."""
    total = rows.count()
    return sample_n(rows, round(fraction * total), key, seed, range_rows, total)


def shuffled(rows: DataFrame, key: str = "row_key", seed: int = 42) -> DataFrame:
    """The table in a repeatable random order (a range-partitioned sort)."""
    return rows.orderBy(seeded_hash(seed, F.col(key)), key)
