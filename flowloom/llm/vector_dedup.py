"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the centred unit vectors is learned on a bounded sample, thinned so that near copies
have one vote: by turns the nearest corner of the cube is taken and the rotation that fits those
corners best. Each bit is cut at its median, so codes are balanced. A code of 64 bits is cut into four words of 16. Two
vectors meet where some word of theirs differs in at most `2 * flips` bits: each vector is
filed under every word within one flip of its own, so both ends reach the words between them.

Only codes are filed. A pair counts in one bucket alone, the first word by which it meets and
there the middle word with the lower bit clear, so nothing is deduplicated afterwards.
A bucket hands on the pairs within `radius` bits or, where those would be many times its
members, its members as one cluster. Buckets of more than `bucket_rows` are clusters cut into
blocks, every two blocks a group of their own. Clusters then meet the vectors, the
cosine is taken in double precision, and each group gives for every vector how many it is
linked to and one vector it hangs together with: rows grow with the members and not with
their pairs. Equal vectors are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from flowloom.llm.common import sample_by_hash
from flowloom.llm.near_dedup import components
from flowloom.session import settle

BITS, WORDS, WORD_BITS = 64, 4, 16
Model = tuple[np.ndarray, np.ndarray, np.ndarray]


def usable(vector: Column) -> Column:
    """True for vectors that are neither null nor zero and hold no null or non-finite component."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(wide, lambda x: x != 0), F.lit(False))


def thinned(x: np.ndarray, threshold: float = 0.9) -> np.ndarray:
    """The unit rows of x without those within `threshold` of one before them: a large group of near copies has one vote."""
    stays = np.ones(len(x), bool)
    for i in range(len(x)):
        if stays[i]:
            stays[i + 1 :] &= x[i + 1 :] @ x[i] < threshold
    return x[stays]


def fit_rotation(x: np.ndarray, dim: int, bits: int = BITS, rounds: int = 40, seed: int = 7) -> Model:
    """(centre, frame, cuts) by iterative quantisation of unit rows: bit j of v is (v - centre) @ frame[:, j] > cuts[j].

    With fewer dimensions than bits, further rotations from other starts follow. Fewer rows than bits teach
    nothing: the frame is a random rotation about the origin.
    """
    draw, frames, width = np.random.default_rng(seed), [], 0
    learned = len(x) >= bits
    centre = x.mean(0) if learned else np.zeros(dim)
    while width < bits:
        turn = np.linalg.qr(draw.normal(size=(dim, min(dim, bits))))[0]
        for _ in range(rounds if learned else 0):
            corners = np.where((x - centre) @ turn > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd((x - centre).T @ corners, full_matrices=False)
            turn = u @ vt
        frames.append(turn)
        width += turn.shape[1]
    frame = np.concatenate(frames, axis=1)[:, :bits]
    return centre, frame, np.median((x - centre) @ frame, axis=0) if learned else np.zeros(bits)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as doubles of unit norm, scaled first so that no square overflows."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codes_of(x: np.ndarray, model: Model) -> np.ndarray:
    centre, frame, cuts = model
    return np.packbits((x - centre) @ frame > cuts, axis=1).view(">i8").astype(np.int64).ravel()


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield int(n), batch.filter(pa.array(lengths == n))


def learn(vectors: DataFrame, sample_rows: int = 4096) -> dict[int, Model]:
    """A rotation for each length among the `sample_rows` vectors (v) of the lowest hash: the bound of what the driver gets."""
    found: dict[int, list] = {}
    for row in sample_by_hash(vectors.select("v"), F.xxhash64("v"), sample_rows).collect():
        found.setdefault(len(row.v), []).append(row.v)
    return {n: fit_rotation(thinned(_matrix(pa.array(rows, pa.list_(pa.float64())))), n) for n, rows in found.items()}


def with_codes(vectors: DataFrame, models: dict[int, Model]) -> DataFrame:
    """`vectors` (v, first_id, copies) with a 64-bit code; a length that the sample has missed is coded by an untrained rotation."""
    kind = vectors.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare: dict[int, tuple] = {}
        for batch in batches:
            for n, part in _by_length(batch, "v"):
                model = models.get(n) or spare.setdefault(n, fit_rotation(np.empty((0, n)), n))
                code = pa.array(codes_of(_matrix(part.column("v")), model))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("v", "first_id", "copies")), code], ["v", "first_id", "copies", "code"])

    return vectors.mapInArrow(run, f"v {kind}, first_id long, copies long, code long")


def filed(nodes: DataFrame) -> DataFrame:
    """(dim, block, word, node, code): every node under its four words and every word one flip away."""
    flips = [0] + [1 << i for i in range(WORD_BITS)]
    keys = [F.struct(F.lit(b).alias("block"), F.shiftrightunsigned("code", b * WORD_BITS).bitwiseAND(F.lit((1 << WORD_BITS) - 1)).bitwiseXOR(F.lit(f)).cast("int").alias("word"))
            for b in range(WORDS) for f in flips]
    return nodes.select(F.size("v").alias("dim"), "node", "code", F.explode(F.array(*keys)).alias("key")).select("dim", "key.block", "key.word", "node", "code")


def _first_meeting(x: np.ndarray, block: np.ndarray | int) -> np.ndarray:
    """Whether codes that differ by x meet in no word before `block`."""
    ok = np.ones(x.shape, bool)
    for b in range(WORDS - 1):
        near = np.bitwise_count((x >> np.uint64(b * WORD_BITS)) & np.uint64(0xFFFF)) <= 2
        ok &= ~(near & (b < block))
    return ok


def _middle_word(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the words between two words at most two flips apart, the one that counts: the lowest bit in which they differ is clear."""
    x = a ^ b
    low = x & (~x + np.uint64(1))
    one, other = a ^ low, a ^ x ^ low
    return np.where(one & low, other, one)


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches, cut anew so that no run of equal keys is split: (table, bounds of its runs)."""
    held: list[pa.RecordBatch] = []

    def runs(t: pa.Table) -> np.ndarray:
        change = np.zeros(max(t.num_rows - 1, 0), bool)
        for k in keys:
            v = t.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [t.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        same = held and all(held[-1].column(k)[-1] == batch.column(k)[0] and batch.column(k)[0] == batch.column(k)[-1] for k in keys)
        held.append(batch)
        if same:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        bounds = runs(t)
        if len(bounds) > 2:
            yield t.slice(0, bounds[-2]), bounds[:-1]
            held = t.slice(bounds[-2]).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, runs(t)


CLUSTERS = "c1 long, c2 long, i int, j int, part int, block int, word int, node long"


def candidates(buckets: DataFrame, radius: int, dense: int) -> DataFrame:
    """Pairs within `radius` bits that count in their bucket, as clusters of two; a bucket with more than `dense` of
    them a member is one cluster. Rows come sorted by bucket, whose rows are bounded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in _whole_runs(batches, ["dim", "block", "word"]):
            node, code = t.column("node").to_numpy(), t.column("code").to_numpy().view(np.uint64)
            dim, block, word = (t.column(c).to_numpy().astype(np.int64) for c in ("dim", "block", "word"))
            size = np.diff(bounds)
            run_of = np.repeat(np.arange(len(size)), size)
            left = np.repeat(bounds[1:], size) - np.arange(t.num_rows)  # rows up to the end of the run
            at, pairs, step = np.flatnonzero(left > 1), [], 1
            while len(at):
                x = code[at] ^ code[at + step]
                ok = np.bitwise_count(x) <= radius
                i, x = at[ok], x[ok]
                shift = (block[i] * WORD_BITS).astype(np.uint64)
                a, b = (code[i] >> shift) & np.uint64(0xFFFF), (code[i + step] >> shift) & np.uint64(0xFFFF)
                ok = (_middle_word(a, b) == word[i].astype(np.uint64)) & _first_meeting(x, block[i])
                pairs.append((i[ok], i[ok] + step))
                step += 1
                at = at[left[at] > step]
            i = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.int64)])
            j = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.int64)])
            many = np.bincount(run_of[i], minlength=len(size)) > dense * size
            sparse = ~many[run_of[i]]
            a, b = np.minimum(node[i[sparse]], node[j[sparse]]), np.maximum(node[i[sparse]], node[j[sparse]])
            whole = np.flatnonzero(many[run_of])
            none = np.full(2 * len(a), -1, np.int64)
            columns = [np.concatenate(c) for c in (
                (a, a, -1 - (block[whole] << WORD_BITS) - word[whole]), (b, b, dim[whole]), *([(0 * none, 0 * whole)] * 3),
                (none, block[whole]), (none, word[whole]), (a, b, node[whole]))]
            schema = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), *((c, pa.int32()) for c in ("i", "j", "part", "block", "word")), ("node", pa.int64())])
            yield from pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema).to_batches(max_chunksize=65_536)

    return buckets.mapInArrow(run, CLUSTERS)


def blocks_of(members: DataFrame, bucket_rows: int) -> DataFrame:
    """Members (with n, the rows of their bucket) of wide buckets, cut into blocks; each two blocks are a group."""
    blocks = F.ceil(F.col("n") / bucket_rows).cast("int")
    dealt = members.withColumn("part", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select((-1 - F.shiftleft(F.col("block").cast("long"), WORD_BITS) - F.col("word")).alias("c1"), F.col("dim").cast("long").alias("c2"),
                        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "block", "word", "node")


def _together(linked: np.ndarray) -> np.ndarray:
    """For each row the smallest row that it hangs together with by links."""
    label = np.arange(len(linked))
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(reach, label[None, :], len(label)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified(clusters: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) for every node with a link in its group: vectors linked there (each copy counts), one node they lead to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in _whole_runs(batches, ["c1", "c2", "i", "j"]):
            node, copies, code = t.column("node").to_numpy(), t.column("copies").to_numpy(), t.column("code").to_numpy().view(np.uint64)
            block, word, part = (t.column(c).to_numpy() for c in ("block", "word", "part"))
            vectors, out = t.column("v").combine_chunks(), []
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            size, first = np.diff(bounds), bounds[:-1]
            for n in np.unique(lengths[first]):
                two = first[(size == 2) & (block[first] < 0) & (lengths[first] == n)]
                if len(two):
                    x, y = _matrix(vectors.take(pa.array(two))), _matrix(vectors.take(pa.array(two + 1)))
                    hit = two[(x * y).sum(axis=1) >= threshold]
                    low = np.minimum(node[hit], node[hit + 1])
                    out += [(node[hit], copies[hit + 1], low), (node[hit + 1], copies[hit], low)]
            for s, e in zip(first[block[first] >= 0], bounds[1:][block[first] >= 0]):
                x, words = _matrix(vectors.slice(s, e - s)), (code[s:e] >> np.uint64(block[s] * WORD_BITS)) & np.uint64(0xFFFF)
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, False)
                if part[s] != part[e - 1]:  # rows of two blocks, sorted by block; pairs inside a block are another group's
                    linked &= part[s:e, None] != part[None, s:e]
                a, b = np.nonzero(linked)
                keep = (_middle_word(words[a], words[b]) == np.uint64(word[s])) & _first_meeting(code[s + a] ^ code[s + b], int(block[s]))
                linked[a[~keep], b[~keep]] = False
                has = np.flatnonzero(linked.any(axis=1))
                out.append((node[s:e][has], (linked @ copies[s:e])[has], node[s:e][_together(linked)[has]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["node", "links", "root"])

    return clusters.mapInArrow(run, "node long, links long, root long")


def near_duplicates(data: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, radius: int = 16,
                    sample_rows: int = 4096, bucket_rows: int = 2048, dense: int = 4) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: rows linked directly to it by a cosine of at least
    `threshold`, the smallest id reachable by links, and whether that is its own.

    Links are those of equal vectors and those found through the codes, all verified. Vectors of different
    lengths have no link, nor have rows whose vector is null, empty or zero or holds a null or non-finite
    component, nor rows without an id (component_id and kept are null then). Repeated rows are vectors of their own, each
    linked to the others of its vector. An empty table gives no rows; other columns are not read.
    """
    kind = data.schema[vector_col].dataType
    source = F.col(vector_col) if kind == ArrayType(FloatType(), kind.containsNull) else F.transform(vector_col, lambda x: x.cast("double"))
    rows = data.select(F.col(id_col).cast("long").alias("id"), F.when(usable(F.col(vector_col)) & F.col(id_col).isNotNull(), source).alias("v"))
    good = rows.filter(F.col("v").isNotNull())
    distinct = settle(good.groupBy("v").agg(F.min("id").alias("first_id"), F.count("*").alias("copies")), "vectors-distinct")
    nodes = settle(with_codes(distinct, learn(distinct, sample_rows)).withColumn("node", F.monotonically_increasing_id()), "vectors-nodes")

    bucket = ["dim", "block", "word"]
    rows_of = filed(nodes)
    wide = settle(rows_of.groupBy(*bucket).agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows), "vectors-wide")
    narrow = rows_of.join(wide, bucket, "left_anti").repartition(*bucket).sortWithinPartitions(*bucket)
    clusters = candidates(narrow, radius, dense).unionByName(blocks_of(rows_of.join(wide, bucket), bucket_rows))
    group = ["c1", "c2", "i", "j"]
    full = clusters.join(nodes.select("node", "v", "code", "copies"), "node").repartition(*group).sortWithinPartitions(*group, "part")
    found = settle(verified(full, threshold), "vectors-found")

    roots = components(found.filter(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "v", "first_id", "copies").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component"))
    known = known.join(smallest, "root").select("v", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    component = F.coalesce("component", "id")
    return rows.join(known, "v", "left").select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                                                component.alias("component_id"), (F.col("id") == component).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings WHERE vec_id IS NOT NULL
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), part AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, p.component_id, e.vec_id = p.component_id AS kept
FROM embeddings e LEFT JOIN part p ON e.vec_id = p.a LEFT JOIN degree d ON e.vec_id = d.a
"""
