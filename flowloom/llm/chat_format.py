"""Chat formatting of the maximal conversations of a log that holds cumulative snapshots.

A log often holds a conversation several times, each time some turns longer. The
first n turns of a conversation have a rolling hash: the running sum of a hash of
(position, role, text), so equal prefixes have equal sums. A conversation whose whole
hash is the hash of a proper prefix of another one is a snapshot and goes by an
anti-join; of equal conversations the one with the smallest id stays. The rest is
rendered turn by turn.

Running sums are taken inside stretches of `stretch` turn numbers and shifted by the
sums of the stretches before, so a conversation with a third of all rows is many
groups, not one. Prefixes and whole hashes are reduced to distinct ones before they
are joined, so a common first turn is one row. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SUMS = ("a", "b", "c", "d")
#: A turn's frame; the same strings inside a text are broken up by a backslash (fixed values).
START, END = "<|im_start|>", "<|im_end|>"


def _halves(hashed: Column, names: tuple[str, str]) -> list[Column]:
    """A 64-bit value as two numbers whose sums can't overflow."""
    return [F.shiftright(hashed, 32).alias(names[0]), hashed.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias(names[1])]


def turn_prefixes(turns: DataFrame, stretch: int = 1024) -> DataFrame:
    """(conv, turn, role, text, part, position, turns, key1, key2) for a table (conv, turn, role, text).

    position counts from 1; turns is the length of the conversation; key1 and key2 hash
    its first `position` turns. Equal rows count once; turns of equal number are in the
    order of role and text, a null number comes last.
    """
    rows = turns.distinct().withColumn("part", F.coalesce(F.floor(F.col("turn") / stretch), F.lit((1 << 62))))
    inside = W.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())
    rows = rows.withColumn("place", F.row_number().over(inside))
    by_conv = W.partitionBy("conv")
    before = by_conv.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # places to positions: turns of the stretches before
    key = [F.col("conv").alias("of_conv"), F.col("part").alias("of_part")]
    same = F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("part") == F.col("of_part"))
    lengths = rows.groupBy("conv", "part").agg(F.count("*").alias("n")).select(
        *key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"), F.sum("n").over(by_conv).alias("turns"))
    rows = rows.join(lengths, same).select(
        "conv", "turn", "role", "text", "part", (F.col("place") + F.col("skip")).alias("position"), "turns")
    said = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    hashes = [*_halves(F.xxhash64(F.lit(1), F.col("position"), *said), SUMS[:2]), *_halves(F.xxhash64(F.lit(2), F.col("position"), *said), SUMS[2:])]
    rows = rows.select("*", *hashes)
    running = W.partitionBy("conv", "part").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.select("conv", "turn", "role", "text", "part", "position", "turns", *[F.sum(c).over(running).alias(c) for c in SUMS])
    # sums of the stretches before; the last row of a stretch has the whole sum of it
    ends = rows.groupBy("conv", "part").agg(F.max_by(F.struct(*SUMS), "position").alias("s")).select(
        *key, *[F.coalesce(F.sum(f"s.{c}").over(before), F.lit(0)).alias(f"{c}0") for c in SUMS])
    return rows.join(ends, same).select(
        "conv", "turn", "role", "text", "part", "position", "turns",
        F.xxhash64(F.col("a") + F.col("a0"), F.col("b") + F.col("b0")).alias("key1"),
        F.xxhash64(F.col("c") + F.col("c0"), F.col("d") + F.col("d0")).alias("key2"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv, copies): conversations that are no proper prefix of another one, one of each kind."""
    key = ["position", "key1", "key2"]
    longer = prefixes.filter(F.col("position") < F.col("turns")).select(key).distinct()
    whole = prefixes.filter(F.col("position") == F.col("turns")).groupBy(key).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    return whole.join(longer, key, "left_anti").select("conv", "copies")


def render_turn(role: Column, text: Column) -> Column:
    shown = F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", r"<\\|$1|>")
    return F.concat(F.lit(START), F.coalesce(role, F.lit("unknown")), F.lit("\n"), shown, F.lit(END + "\n"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", stretch: int = 1024) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, copies, text.

    A conversation is one row, or one row for each `stretch` turn numbers (part counts
    from 0 in their order), whose texts joined are the whole. copies is the number of
    equal conversations. A null conversation id is a conversation of its own; a null
    role is `unknown`, a null text empty, null turn numbers come last. An empty table
    gives no rows; other columns are not read.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    prefixes = turn_prefixes(rows, stretch)
    kept = maximal_conversations(prefixes).withColumnRenamed("conv", "of_conv")
    said = prefixes.join(kept, F.col("conv").eqNullSafe(F.col("of_conv"))).select(
        "conv", "part", "position", "turns", "copies", render_turn(F.col("role"), F.col("text")).alias("said"))
    parts = said.groupBy("conv", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "said"))), lambda x: x["said"]), "").alias("text"),
        F.max("turns").alias("n_turns"), F.max("copies").alias("copies"))
    number = F.row_number().over(W.partitionBy("conv").orderBy("part")) - 1
    return parts.select(F.col("conv").alias(conv_col), number.alias("part"), "n_turns", "copies", F.col("text").alias(text_col))


ORACLE = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), whole AS (
  SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn, role, text) AS l, count(*) AS n,
    string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10)
      || regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<\\|\1|>', 'g') || '<|im_end|>' || chr(10), ''
      ORDER BY turn, role, text) AS text
  FROM said GROUP BY conv_id
), one AS (
  SELECT min(conv_id) AS conv_id, l, n, text, count(*) AS copies FROM whole GROUP BY l, n, text
)
SELECT a.conv_id, CAST(0 AS INTEGER) AS part, CAST(a.n AS BIGINT) AS n_turns, CAST(a.copies AS BIGINT) AS copies, a.text
FROM one a
WHERE NOT EXISTS (SELECT 1 FROM one b WHERE b.l[1] = a.l[1] AND b.n > a.n AND b.l[1:a.n] = a.l)
"""
