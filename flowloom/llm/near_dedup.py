"""Near-duplicate texts by ProbMinHash, banding and exact verification.

The similarity of two texts is the probability Jaccard of their weighted word shingles (a
shingle that stands n times weighs 1 + ln n; for texts without repeats it is the plain Jaccard).
A signature has `slots` places. Each shingle is a Poisson process whose rate is its weight
and whose randomness comes from its hash alone; each arrival falls on a random place, and the first
shingle to arrive at a place stays there. Two texts agree at a place with the probability that
is their similarity. A process is stopped as soon as its next arrival is later than
the last first arrival over all places, so a text costs little more than its shingles.

Signatures are cut into bands; texts that agree in a whole band share a bucket. With 32
bands of 5 places a pair of similarity 0.8 shares none with probability 3e-6. Inside a
bucket no pairs are listed: each text is verified against two texts of the bucket, the
one with the smallest key and one drawn at random by band. The links give components.
A bucket that still spans several of them is cut into blocks of bounded shingles, those of its heaviest
component apart from the rest; each block of the rest meets every block, so that every two texts of
different components meet, and no link between buckets' texts is lost. A meeting is solved in one task:
an inverted index of its shingles bounds the similarity of a text to all others at once, pairs that reach
the threshold are verified, and components that grow together there need no more verification. Only
links leave the task, never the pairs. Equal texts are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import tidy
from flowloom.session import settle

GOLD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)


def normalised(text: Column) -> Column:
    """Lower-cased runs of letters and digits, joined by single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return (np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, BASE, np.uint64))]),
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, inverse, np.uint64))]))


def shingles(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of every different k-word shingle, ordered by text and hash.

    `texts` are normalised. One of fewer than k words has one shingle, one without words none.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if not len(texts) or len(data) < 2:
        return none
    size = 1 << (len(data) + 1).bit_length()
    power, inverse = _powers(size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
        blank = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], blank[:-1] + 1])
        word = mix((sums[blank] - sums[starts]) * inverse[starts] + (blank - starts).astype(np.uint64) * GOLD)
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths + 1)  # place of the blank behind each text, plus one
        owner = np.searchsorted(ends, starts, "right")
        real = blank > starts  # an empty text leaves a word without letters
        word, owner = word[real], owner[real]
        if not len(word):
            return none
        n_words = np.bincount(owner, minlength=len(texts))
        first = np.concatenate([[0], np.cumsum(n_words)])[owner]
        left = n_words[owner] - (np.arange(len(word)) - first)  # words from here to the end of the text
        whole = np.zeros(len(word), np.uint64)
        for j in range(k):
            ahead = np.concatenate([word[j:], np.zeros(min(j, len(word)), np.uint64)])
            whole += np.where(left > j, ahead * (GOLD * np.uint64(2 * j + 1)), np.uint64(0))
            whole = mix(whole + np.uint64(1))
    keep = (left >= k) | ((n_words[owner] < k) & (left == n_words[owner]))
    owner, whole = owner[keep], whole[keep]
    order = np.lexsort((whole, owner))
    owner, whole = owner[order], whole[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])]))
    return owner[new], whole[new], np.diff(np.append(new, len(owner)))


def weight(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def signatures(n_texts: int, owner: np.ndarray, element: np.ndarray, weights: np.ndarray, slots: int) -> np.ndarray:
    """ProbMinHash signature [text, slot]: the first element to arrive; 0 throughout for a text without elements."""
    first = np.full((n_texts, slots), np.inf)
    sign = np.zeros((n_texts, slots), np.uint64)
    flat_first, flat_sign = first.reshape(-1), sign.reshape(-1)
    stop = np.full(n_texts, np.inf)
    at, state, round_ = np.zeros(len(element)), element.copy(), 0
    while len(element):
        with np.errstate(over="ignore"):
            state = state + GOLD
            random = mix(state)
            slot = (mix(random ^ GOLD) % np.uint64(slots)).astype(np.int64)
        at = at - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        place = owner * slots + slot
        early = np.flatnonzero(at < flat_first[place])
        if len(early):
            np.minimum.at(flat_first, place[early], at[early])
            won = early[flat_first[place[early]] == at[early]]
            flat_sign[place[won]] = element[won]
        round_ += 1
        if round_ <= 4 or round_ % 4 == 0:
            live = np.unique(owner) if round_ > 8 else slice(None)
            stop[live] = first[live].max(axis=1)
        going = at < stop[owner]
        owner, element, weights, at, state = owner[going], element[going], weights[going], at[going], state[going]
    return sign


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets, given by sorted elements and their weights."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    every = np.union1d(a, b)
    u, v = np.zeros(len(every)), np.zeros(len(every))
    u[np.searchsorted(every, a)] = x
    v[np.searchsorted(every, b)] = y
    ratio = np.where(u > 0, v / np.where(u > 0, u, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    u, v, ratio = u[order], v[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, "right")  # of equal ratios all are on the left
    left, right = np.append(0, np.cumsum(u))[upto], v.sum() - np.append(0, np.cumsum(v))[upto]
    both = (u > 0) & (v > 0)
    return float((1 / (left[both] / u[both] + right[both] / v[both])).sum())


def _chunks(batch: pa.RecordBatch, most_rows: int = 1000, most_bytes: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in parts of bounded rows and bytes (one text may be longer), each with its texts."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(max(int(np.searchsorted(ends, before + most_bytes, "right")), at + 1), at + most_rows)
        part = batch.slice(at, to - at)
        yield part, [t.encode() for t in part.column("text").to_pylist()]
        at = to


def with_bands(rows: DataFrame, bands: int, rows_per_band: int, k: int) -> DataFrame:
    """(node, size, keys): shingles of each row (node, text) and one hash for each band of its signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _chunks(batch):
                owner, element, count = shingles(texts, k)
                sign = signatures(len(texts), owner, element, weight(count), bands * rows_per_band)
                with np.errstate(over="ignore"):
                    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * GOLD, (len(texts), bands)).copy()
                    for j in range(rows_per_band):
                        key = mix(key + sign[:, j::rows_per_band] * GOLD)
                size = np.bincount(owner, minlength=len(texts))
                flat = pa.array(key[size > 0].astype(np.int64).reshape(-1))
                offsets = np.append(0, np.cumsum(np.where(size > 0, bands, 0))).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), flat)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(size.astype(np.int64)), keys], ["node", "size", "keys"])

    return rows.select("node", normalised(F.col("text")).alias("text")).mapInArrow(tidy(run), "node binary, size long, keys array<long>")


def with_elements(rows: DataFrame, k: int) -> DataFrame:
    """(node, e): the shingles of each row (node, text), as hashes, each as often as it stands there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _chunks(batch):
                owner, element, count = shingles(texts, k)
                flat = pa.array(np.repeat(element, count).astype(np.int64))
                offsets = np.append(0, np.cumsum(np.bincount(np.repeat(owner, count), minlength=len(texts)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["node", "e"])

    return rows.select("node", normalised(F.col("text")).alias("text")).mapInArrow(tidy(run), "node binary, e array<long>")


def _verified(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column("ea"), batch.column("eb")):
                a, x = np.unique(a.values.to_numpy(), return_counts=True)
                b, y = np.unique(b.values.to_numpy(), return_counts=True)
                out.append(similarity(a, weight(x), b, weight(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return pairs.mapInArrow(tidy(run), "a binary, b binary, similarity double")


def blocks_of(open_: DataFrame, block_elements: int) -> DataFrame:
    """Members (key, node, root, size) of open buckets, dealt to the meetings (key, i, j) of two blocks.

    Blocks hold about `block_elements` shingles. The bucket's heaviest component has blocks of its own, which meet
    only those of the rest, as its members need no verification against each other.
    """
    by_root = open_.groupBy("key", "root").agg(F.sum("size").alias("own"))
    heavy = by_root.groupBy("key").agg(F.max_by("root", F.struct("own", "root")).alias("main"), F.max("own").alias("main_size"), F.sum("own").alias("whole"))
    blocks = heavy.select("key", "main", F.ceil(F.col("main_size") / block_elements).cast("int").alias("of_main"),
                          F.ceil((F.col("whole") - F.col("main_size")) / block_elements).cast("int").alias("of_rest"))
    is_main, place = F.col("root") == F.col("main"), F.xxhash64("node", F.lit("block"))
    part = F.when(is_main, F.col("of_rest") + F.pmod(place, "of_main")).otherwise(F.pmod(place, "of_rest")).cast("int")
    meets = F.col("of_rest") + F.when(is_main, 0).otherwise(F.col("of_main"))
    dealt = open_.join(blocks, "key").select("key", "node", "root", part.alias("part"), F.explode(F.sequence(F.lit(0), meets - 1)).alias("other"))
    return dealt.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "root")


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (key, i, j) at a time, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in ("key", "i", "j")]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("key", "i", "j")):
            yield pa.Table.from_batches(held)
            held = []
        bounds = np.concatenate([[0], new, [batch.num_rows]])
        for s, e in zip(bounds[:-1], bounds[1:]):
            if s:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def links_of_meeting(root: np.ndarray, part: np.ndarray, elements: list[np.ndarray], threshold: float) -> list[tuple[int, int, float]]:
    """Verified links (row, row, similarity) that join the components `root` of a meeting, as few as join them.

    Rows of one part are another meeting's unless all are of one part. With weights x and y that sum to X and Y, and
    Xb and Yb over the common elements, the similarity is at most the sum of max(x, y) over these
    by X + Y - min(Xb, Yb); without repeated elements that is the similarity.
    """
    n = len(root)
    sets = [np.unique(e, return_counts=True) for e in elements]
    sets = [(e, weight(c)) for e, c in sets]
    total = np.array([x.sum() for _, x in sets])
    owner = np.repeat(np.arange(n), [len(e) for e, _ in sets])
    x = np.concatenate([w for _, w in sets])
    found, place = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True)
    start = np.append(0, np.cumsum(np.bincount(place, minlength=len(found))))
    first = np.append(0, np.cumsum([len(e) for e, _ in sets]))
    order = np.argsort(place, kind="stable")
    posted, posted_x = owner[order], x[order]
    comp = np.unique(root, return_inverse=True)[1]
    main = comp == np.argmax(np.bincount(comp))
    one_part, row, out = part.min() == part.max(), np.arange(n), []
    for i in np.flatnonzero(~main):
        open_ = (comp != comp[i]) & (main | (row > i)) & (one_part | (part != part[i]))
        if not open_.any():
            continue
        own = place[first[i] : first[i + 1]]
        long = start[own + 1] - start[own]
        at = np.arange(long.sum()) + np.repeat(start[own] - np.append(0, np.cumsum(long)[:-1]), long)
        who, a, b = posted[at], np.repeat(x[first[i] : first[i + 1]], long), posted_x[at]
        high = np.bincount(who, np.maximum(a, b), n)
        low = np.minimum(np.bincount(who, a, n), np.bincount(who, b, n))
        bound = high / (total[i] + total - low)
        maybe = np.flatnonzero(open_ & (bound >= threshold - 1e-9))
        for j in maybe[np.argsort(-bound[maybe], kind="stable")]:
            if comp[j] != comp[i]:
                alike = similarity(*sets[i], *sets[j])
                if alike >= threshold:
                    out.append((int(i), int(j), alike))
                    comp[comp == comp[i]] = comp[j]
    return out


def joining_links(meetings: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity, root_a, root_b): links between components, from rows (key, i, j, part, node, root, e) sorted by meeting."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _meetings(batches):
            if t.num_rows < 2:
                continue
            node, root = t.column("node").to_pylist(), t.column("root").to_pylist()
            e = t.column("e").combine_chunks()
            flat, ends = e.flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(e).to_numpy(zero_copy_only=False)))
            elements = [flat[s:f] for s, f in zip(ends[:-1], ends[1:])]
            links = links_of_meeting(np.array([r.hex() for r in root]), t.column("part").to_numpy(), elements, threshold)
            rows = [(min(node[i], node[j]), max(node[i], node[j]), s, root[i], root[j]) for i, j, s in links]
            if rows:
                kinds = (pa.binary(), pa.binary(), pa.float64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["a", "b", "similarity", "root_a", "root_b"])

    return meetings.mapInArrow(tidy(run), "a binary, b binary, similarity double, root_a binary, root_b binary")


def components(links: DataFrame, label: str = "dedup") -> DataFrame:
    """(node, root): the smallest node of each connected component of the links (a, b).

    Each round hangs every node under its smallest neighbour, shortens the trees to stars and keeps of the links only
    those between different roots, once each. At least half of the nodes are no roots, so rounds are at most the
    logarithm of the nodes, and links inside a group are joined in one round only. Each step is a written table.
    """
    def lower_first(a: Column | str, b: Column | str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    edges = settle(links.select(*lower_first("a", "b")).distinct(), f"{label}-edges")
    roots = None
    while True:
        both = edges.union(edges.select("b", "a"))
        tree = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), f"{label}-tree")
        while True:
            new = tree.withColumn("was", F.col("root"))
            for _ in range(2):
                up = new.select(F.col("node").alias("root"), F.col("root").alias("up"))
                new = new.join(up, "root").select("node", "was", F.col("up").alias("root"))
            new = settle(new, f"{label}-tree")
            tree = new.select("node", "root")
            if new.filter(F.col("was") != F.col("root")).isEmpty():
                break
        if roots is None:
            roots = tree
        else:
            up = tree.select(F.col("node").alias("root"), F.col("root").alias("up"))
            roots = settle(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"{label}-roots")
        ends = (edges.join(tree.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a")
                .join(tree.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b").filter(F.col("root_a") != F.col("root_b")))
        edges = settle(ends.select(*lower_first("root_a", "root_b")).distinct(), f"{label}-edges")
        if edges.isEmpty():
            return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, k: int = 5,
                    bands: int = 32, rows_per_band: int = 5, block_elements: int = 500_000) -> DataFrame:
    """One row per row of `docs`: id, class_id (smallest id of its class), class_texts (different texts), links (similar
    texts that were verified for its text).

    Rows of equal text are in one class; a null text counts as empty, and texts without words are alike
    only if equal. A null id belongs to its text's class. Repeated rows stay; other columns are not
    read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("node", node_of(F.col("text")))
    known = text_classes(rows, threshold, k, bands, rows_per_band, block_elements)
    return rows.select("id", "node").join(known, "node").select(F.col("id").alias(id_col), "class_id", "class_texts", "links")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, k: int = 5,
                    bands: int = 32, rows_per_band: int = 5, block_elements: int = 500_000) -> DataFrame:
    """The rows of `docs` of which one for each class stays: that of the smallest id; of rows equal in id and text, one."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("node", node_of(F.col("text")))
    known = text_classes(rows, threshold, k, bands, rows_per_band, block_elements)
    keepers = known.filter("keeper").select(F.col("node").alias("of_node"), F.col("first_id").alias("of_id"))
    own = node_of(docs[text_col]) == F.col("of_node")
    kept = docs.join(keepers, own & docs[id_col].eqNullSafe(F.col("of_id"))).drop("of_id")
    again = rows.groupBy("id", "node").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return (kept if again.isEmpty() else kept.dropDuplicates(["of_node"])).drop("of_node")


def node_of(text: Column) -> Column:
    """Key of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def text_classes(rows: DataFrame, threshold: float, k: int, bands: int, rows_per_band: int, block_elements: int) -> DataFrame:
    """(node, first_id, class_id, class_texts, links, keeper) for each different text of rows (id, text, node)."""
    banded = settle(with_bands(rows, bands, rows_per_band, k), "dedup-bands")
    distinct = banded.groupBy("node").agg(F.first("size").alias("size"), F.first("keys").alias("keys"))
    in_bucket = distinct.select("node", "size", F.explode("keys").alias("key"))
    drawn = F.min_by("node", F.xxhash64("node", "key"))
    buckets = settle(in_bucket.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"), drawn.alias("drawn")).filter(F.col("n") > 1), "dedup-buckets")
    members = settle(in_bucket.join(buckets, "key").select("key", "node", "size", "low", "drawn", "n"), "dedup-members")
    elements = settle(with_elements(rows.join(members.select("node").distinct(), "node").dropDuplicates(["node"]), k), "dedup-elements")

    both = members.select("node", F.explode(F.array("low", "drawn")).alias("other")).filter(F.col("node") != F.col("other"))
    pairs = both.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    full = (pairs.join(elements.select(F.col("node").alias("a"), F.col("e").alias("ea")), "a")
            .join(elements.select(F.col("node").alias("b"), F.col("e").alias("eb")), "b"))
    links = settle(_verified(full).filter(F.col("similarity") >= threshold), "dedup-links")
    roots = components(links)

    # Of a bucket of two, and of three with two different ends, every pair has been verified.
    untested = (F.col("n") > 3) | ((F.col("n") == 3) & (F.col("low") == F.col("drawn")))
    rooted = members.filter(untested).join(roots, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
    wide = rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter(F.col("r0") != F.col("r1"))
    open_ = settle(rooted.join(wide.select("key"), "key"), "dedup-open")
    meeting = ["key", "i", "j"]
    met = blocks_of(open_, block_elements).join(elements, "node").repartition(*meeting).sortWithinPartitions(*meeting)
    joined = settle(joining_links(met, threshold), "dedup-joined")
    if not joined.isEmpty():
        links = links.unionByName(joined.select("a", "b", "similarity").dropDuplicates(["a", "b"]))
        # the components are known already; only these links between them are new
        up = components(joined.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "dedup-joins")
        every = roots.select("node").union(up.select("node")).distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        up = up.select(F.col("node").alias("root"), F.col("root").alias("up"))
        roots = settle(every.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "dedup-roots")

    degree = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("links"))
    nodes = settle(rows.select("id", "node").groupBy("node").agg(F.min("id").alias("id")).join(roots, "node", "left")
                   .join(degree, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "dedup-nodes")
    classes = nodes.groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("class_texts"),
                                        F.min_by("node", F.struct(F.col("id").isNull(), "id", "node")).alias("keeper"))
    return settle(nodes.join(classes, "root").select("node", F.col("id").alias("first_id"), "class_id", "class_texts", "links",
                                                     (F.col("node") == F.col("keeper")).alias("keeper")), "dedup-classes")
