"""Merkle manifest of a dataset: a hash tree for each group of rows and one over the groups.

Leaves of a group ascend by id. No group is sorted for that: ids are merged to sparse bitmaps, one
64-bit word for 64 neighbouring ids, and a directory gives every word the number of leaves before it: bits are counted
within the 1,024 words of a box, boxes within 65,536 and so on over four levels,
so every window of the directory is bounded, and a group with a third of all rows is many
of them. The place of a leaf is its word's start plus the bits below its own (rank). Ids
that stand in several rows are ranked by leaf, by its first digits and then within these.

A place is a slot: sixteen slots make one parent, whose row keeps its children in an array by slot. Level by
level that leaves one node; on the way down every node hands its children the siblings met so
far, so a leaf's proof is joined once for each sixteen leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.session import settle

PATH = "array<struct<before: string, after: string>>"
DIRECTORY = ["top", "span", "box", "word"]


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def framed(field: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*(framed(f) for f in fields)))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(F.concat(s["before"], acc, s["after"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, from the leaf's up to the root, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def numbered(keys: DataFrame, key: str) -> DataFrame:
    """`keys` with `number`, the place of `key` in ascending order from 0: ranges are counted, only one range is sorted at a time."""
    ranges = settle(keys.repartitionByRange(key).withColumn("range", F.spark_partition_id()), "merkle-ranges")
    counts = ranges.groupBy("range").agg(F.count("*").alias("n"))  # a row a partition
    starts = counts.withColumn("start", _before("n", [], "range")).drop("n")
    place = F.row_number().over(W.partitionBy("range").orderBy(key)) - 1
    return ranges.withColumn("place", place).join(starts, "range").withColumn("number", F.col("start") + F.col("place")).drop("range", "place", "start")


def _before(n: str, within: list[str], order: str) -> Column:
    """Sum of `n` over the smaller values of `order`."""
    window = W.partitionBy(*(within or [F.lit(0)])).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(window), F.lit(0))


def _cut(leaves: DataFrame) -> DataFrame:
    """The parts of an id, from 2**48 ids down to one; null ids have a part of their own before all others."""
    i = F.coalesce("id", F.lit(0))
    return leaves.select("*", F.when(F.col("id").isNull(), -(1 << 16)).otherwise(F.shiftright(i, 48)).cast("int").alias("top"),
                         *(F.shiftright(i, s).bitwiseAND(F.lit((1 << w) - 1)).cast("int").alias(c)
                           for c, s, w in (("span", 32, 16), ("box", 16, 16), ("word", 6, 10), ("bit", 0, 6))))


def directory(leaves: DataFrame) -> DataFrame:
    """(group, parts, bits, n, start): the words of every group's bitmap and how many leaves of the group come before each."""
    keys = ["number", *DIRECTORY]
    words = settle(_cut(leaves).groupBy(*keys).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.sum("n").alias("n")), "merkle-words")
    tables, at = [words], len(keys)
    while at > 2:  # sums of boxes, of 65,536 boxes, and so on
        at -= 1
        tables.append(tables[-1].groupBy(*keys[:at]).agg(F.sum("n").alias("n")))
    starts = None
    for depth, table in zip(range(2, len(keys) + 1), reversed(tables)):
        here = table.withColumn("start", _before("n", keys[: depth - 1], keys[depth - 1]))
        if starts is not None:
            here = here.join(starts.withColumnRenamed("start", "up"), keys[: depth - 1]).withColumn("start", F.col("start") + F.col("up")).drop("up")
        starts = here.select(*keys[:depth], "start") if depth < len(keys) else here
    return settle(starts, "merkle-directory")


def placed(leaves: DataFrame) -> DataFrame:
    """`leaves` (number, id, leaf, .., n) with `pos`, the place of the first of the n equal leaves within their group."""
    keys = ["number", *DIRECTORY]
    words = directory(leaves)
    cut = _cut(leaves).join(words.select(*keys, "bits", "start", (F.col("n") != F.bit_count("bits")).alias("repeats")), keys)
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    once = cut.filter(~F.col("repeats")).withColumn("pos", F.col("start") + below)
    again = cut.filter("repeats")
    if not words.filter(F.col("n") != F.bit_count("bits")).isEmpty():  # ids of several rows: by leaf
        again = settle(again.withColumn("digits", F.substring("leaf", 1, 4)), "merkle-repeats")
        one = [*keys, "bit"]
        parts = again.groupBy(*one, "digits").agg(F.sum("n").alias("m"))
        ids = parts.groupBy(*one).agg(F.sum("m").alias("k"))
        ids = ids.withColumn("to_id", _before("k", keys, "bit")).drop("k")
        parts = parts.withColumn("to_part", _before("m", one, "digits")).drop("m")
        again = (again.withColumn("to_leaf", _before("n", [*one, "digits"], "leaf")).join(parts, [*one, "digits"]).join(ids, one)
                 .withColumn("pos", F.col("start") + F.col("to_id") + F.col("to_part") + F.col("to_leaf")))
        once = once.unionByName(again.select(*once.columns))
    return once.select(*leaves.columns, "pos")


def _each_copy(leaves: DataFrame, at_once: int = 1 << 16) -> DataFrame:
    """A row for each of the n copies, each with its own place."""
    span = F.col("n") - 1
    many = leaves.withColumn("far", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {at_once}"))))
    far = F.col("far") * at_once
    return many.withColumn("near", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(at_once - 1), span - far)))).withColumn(
        "pos", F.col("pos") + far + F.col("near")).drop("far", "near", "n")


def _runs(nodes: DataFrame, fan: int, extra: Sequence[str] = ()) -> DataFrame:
    """Parents (number, size, pos, children, texts, hash) of nodes (number, pos, hash, size = nodes of their group at this level).

    A group of one node stays as it is.
    """
    child = F.struct((F.col("pos") % fan).cast("int").alias("slot"), "hash", *extra)
    runs = nodes.groupBy("number", "size", F.expr(f"pos div {fan}").alias("pos")).agg(F.sort_array(F.collect_list(child)).alias("children"))
    runs = runs.withColumn("texts", F.array_join(F.col("children.hash"), ""))
    return settle(runs.withColumn("hash", F.when(F.col("size") == 1, F.col("texts")).otherwise(digest(F.col("texts")))), "merkle-level")


class Tree:
    """Levels of the trees of all groups, each a written table, and the top node of every group."""

    def __init__(self, nodes: DataFrame, fan: int = 16, extra: Sequence[str] = ()) -> None:
        self.fan, self.extra = fan, list(extra)
        self.levels = [_runs(nodes, fan, extra)]
        self.largest = self.levels[0].agg(F.max("size")).first()[0] or 0
        while self.largest > fan ** len(self.levels):
            up = self._parents(len(self.levels))
            self.levels.append(_runs(up.filter(F.col("size") > 1), fan))

    def _parents(self, level: int) -> DataFrame:
        """Nodes of a level, from the runs of the one below; their group's size is divided by the fan."""
        return self.levels[level - 1].select("number", "pos", "hash", F.expr(f"(size + {self.fan - 1}) div {self.fan}").alias("size"))

    def tops(self) -> DataFrame:
        """(number, hash) of the node that remains of each group."""
        ones = [self._parents(k).filter((F.col("size") == 1)) for k in range(1, len(self.levels) + 1)]
        out = ones[0]
        for more in ones[1:]:
            out = out.unionByName(more)
        return out.select("number", "hash")

    def paths(self, above: DataFrame) -> DataFrame:
        """Leaves (number, hash, extra, path, above's columns): siblings of each, level by level, then the path that
        `above` (number, path, ..) gives for the group's top."""
        more = [c for c in above.columns if c not in ("number", "path")]
        known = None
        for k in range(len(self.levels), 0, -1):
            here = self._parents(k).filter("size = 1").select("number", "pos").join(above, "number")
            known = here if known is None else here.unionByName(known)
            runs = self.levels[k - 1].select("number", "pos", "size", "children", "texts").join(known, ["number", "pos"])
            each = runs.select("number", "size", F.col("pos").alias("run"), "texts", "path", *more, F.posexplode("children").alias("at", "child"))
            width = F.lit(64)
            entry = F.struct(F.substring("texts", F.lit(1), F.col("at") * width).alias("before"), F.substring("texts", (F.col("at") + 1) * width + 1, F.length("texts")).alias("after"))
            path = F.when(F.col("size") == 1, F.col("path")).otherwise(F.concat(F.array(entry), F.col("path")))
            extra = [F.col(f"child.{c}").alias(c) for c in self.extra] if k == 1 else []
            known = each.select("number", (F.col("run") * self.fan + F.col("child.slot")).alias("pos"), F.col("child.hash").alias("hash"), *extra, path.alias("path"), *more)
            if k > 1:
                known = settle(known.drop("hash"), "merkle-paths")
        return known


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group_col: str = "source",
             fan: int = 16, other: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path, columns of `other`) for each row of `docs`: its hash, that of its group, that of the dataset, and
    the siblings from leaf to root as (before, after) texts. `folded(leaf, path)` is the root for whoever holds the row and the path.

    Leaves ascend by id, null ids first; rows of equal id ascend by leaf; equal rows are as many leaves. Null groups are
    one group, before all others, which ascend bytewise. `other` names expressions over the row to carry along,
    such as the hash of an altered row; they must be the same for equal rows. An empty table gives no rows; other columns are not read.
    """
    other = other or {}
    name = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # null first, then bytewise
    hashed = docs.select(name.alias("name"), F.col(id_col).cast("long").alias("id"), leaf_hash([F.col(f) for f in fields]).alias("leaf"),
                         *(c.alias(f"_{n}") for n, c in other.items()))
    leaves = settle(hashed.groupBy(*hashed.columns).agg(F.count("*").alias("n")), "merkle-leaves")
    groups = settle(numbered(leaves.groupBy("name").agg(F.sum("n").alias("size")), "name"), "merkle-groups")
    carried = [f"_{n}" for n in other]
    rows = leaves.join(groups.select("name", "number"), "name").select("number", "id", "leaf", *carried, "n")
    nodes = _each_copy(placed(settle(rows, "merkle-numbered"))).withColumnRenamed("leaf", "hash").join(groups.select("number", "size"), "number")
    tree = Tree(nodes, fan, ["id", *carried])
    tops = settle(tree.tops(), "merkle-tops")
    count = F.lit(tops.count()).cast("long")
    over = Tree(tops.select(F.lit(0).alias("number"), F.col("number").cast("long").alias("pos"), F.col("hash"), count.alias("size"), F.col("number").alias("of")), fan, ["of"])
    root = over.tops().first()  # one row
    start = over.levels[0].select(F.lit(0).alias("number"), F.array().cast(PATH).alias("path")).distinct()
    above = settle(over.paths(start).select(F.col("of").alias("number"), "path", F.col("hash").alias("subroot")), "merkle-above")
    return tree.paths(above).select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", F.lit(root["hash"] if root else None).cast("string").alias("root"),
                                    "path", *(F.col(f"_{n}").alias(n) for n in other))


def tampering_check(docs: DataFrame) -> DataFrame:
    """Columns of the registered query: one row in five (by crc32 of its id) has the letters of its text in lower case when it is checked."""
    cells = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    found = manifest(docs, other={"shown": F.when(hit, leaf_hash([*cells, lower_ascii(F.col("text"))]))})
    back = folded(F.coalesce("shown", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), back.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(d) + 1), lambda i: ascii(d[i])::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))"""
_FRAME = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_UP = """SELECT g, 0 AS level, pos, hash, count(*) OVER (PARTITION BY g) AS size FROM {0}
  UNION ALL SELECT g, level + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(size) + 15) // 16 FROM {1} WHERE size > 1 GROUP BY g, level, pos // 16"""
_SIDES = """SELECT a.g, a.level, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM {0} a JOIN {0} b ON a.g = b.g AND a.level = b.level AND a.pos // 16 = b.pos // 16 WHERE a.size > 1 GROUP BY a.g, a.level, a.pos"""
ORACLE = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, sha256(concat({', '.join(_FRAME.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))})) AS leaf,
    sha256(concat({', '.join(_FRAME.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))}, {_FRAME.format(_LOW)})) AS shown,
    doc_id::VARCHAR AS d FROM documents
), marked AS (
  SELECT * EXCLUDE (d), CASE WHEN d IS NOT NULL AND xor({_CRC}, 4294967295) % 5 = 0 THEN shown ELSE leaf END AS given,
    dense_rank() OVER (ORDER BY source IS NOT NULL, encode(coalesce(source, ''))) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs
), leaves AS (SELECT g, pos, leaf AS hash FROM marked),
up AS ({_UP.format('leaves', 'up')}),
tops AS (SELECT g, hash FROM up WHERE size = 1),
heads AS (SELECT 0 AS g, g AS pos, hash FROM tops),
over AS ({_UP.format('heads', 'over')}),
sides AS (SELECT 'in' AS part, * FROM ({_SIDES.format('up')}) UNION ALL SELECT 'over', * FROM ({_SIDES.format('over')})),
steps AS (
  SELECT m.g, m.pos, s.level, s.before, s.after FROM marked m JOIN sides s ON s.part = 'in' AND s.g = m.g AND s.pos = m.pos // CAST(16 ** s.level AS BIGINT)
  UNION ALL SELECT m.g, m.pos, 100 + s.level, s.before, s.after FROM marked m JOIN sides s ON s.part = 'over' AND s.pos = m.g // CAST(16 ** s.level AS BIGINT)
), ordered AS (SELECT *, row_number() OVER (PARTITION BY g, pos ORDER BY level) AS step FROM steps),
fold AS (
  SELECT g, pos, 0 AS step, given AS acc FROM marked
  UNION ALL SELECT f.g, f.pos, f.step + 1, sha256(o.before || f.acc || o.after) FROM fold f JOIN ordered o ON o.g = f.g AND o.pos = f.pos AND o.step = f.step + 1
), back AS (SELECT g, pos, arg_max(acc, step) AS folded_root FROM fold GROUP BY g, pos),
proof AS (SELECT g, pos, string_agg(before || after, '' ORDER BY step) AS proof FROM ordered GROUP BY g, pos),
root AS (SELECT hash FROM over WHERE size = 1)
SELECT m.doc_id, m.leaf, t.hash AS subroot, r.hash AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, b.folded_root, b.folded_root = r.hash AS verified
FROM marked m JOIN tops t ON t.g = m.g JOIN back b ON b.g = m.g AND b.pos = m.pos LEFT JOIN proof p ON p.g = m.g AND p.pos = m.pos CROSS JOIN root r
"""
