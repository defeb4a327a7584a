"""Gradient boosting on Spark for two or many classes, with validation, patience and continued training.

Features are cut into bins once; a row is then a few bytes. A round grows one tree for each
class (one tree in all for two classes) from softmax gradients. All trees of a round grow together: one scan sums the
gradients of every open leaf by feature and bin, and the best split of each leaf comes back, so what the driver holds
grows with the leaves and never with the rows. Gradients are summed as whole numbers, so
the same rows and bins give the same trees under any partitioning. The loss of the training and validation rows
is summed in the first scan of the next round. Scores are kept in a written table
that is renewed every few rounds; in between only the trees since then are applied.

Trees grow by level (`depth`) or by leaf (`leaves`: the best `at_once` leaves a scan). With `top_share` and
`rest_share` a round learns from the rows of the largest gradients and a weighted draw of the others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.functions import named
from flowloom.session import new_table_path

UNIT = float(1 << 20)  # gradients are summed in steps of this part of one
FILE_ROWS = 65_536  # rows of one file of the binned table: a row is few bytes but costs time, so bytes would make too few tasks
STORED = "bins binary, y int, w double, draw bigint, held boolean, score array<double>"
LOSS, SIZE = -1, -2  # rows of a scan that are no histogram: losses, gradient sizes


@dataclass
class Tree:
    """Nodes by number; `feature` is -1 for leaves. Rows whose bin is at most `bin` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.bin[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = children
        for v in values:
            for column, x in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, v), (self.gain, 0.0)):
                column.append(x)
        return children

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.bin, self.left, self.right))
        node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            goes_left = bins[row, np.maximum(f, 0)] <= cut[node]
            node = np.where(inner, np.where(goes_left, left[node], right[node]), node)


@dataclass
class BoostedTrees:
    """A fitted ensemble. `rounds` holds the trees of each round; `best_round` of them are used."""

    features: list[str]
    cuts: list[list[float]]  # upper ends of the bins of each feature
    classes: int
    start: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)
    train_losses: list[float] = field(default_factory=list)  # after each round, the first before any
    losses: list[float] = field(default_factory=list)  # of the validation rows
    best_round: int = 0

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        raw = json.loads(text)
        return BoostedTrees(**{**raw, "rounds": [[Tree(**t) for t in r] for r in raw["rounds"]]})

    def importance(self) -> dict[str, float]:
        """Share of the whole gain that each feature's splits brought."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in (t for r in self.rounds[: self.best_round] for t in r):
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    total[self.features[f]] += g
        whole = sum(total.values())
        return {f: g / whole if whole else 0.0 for f, g in total.items()}


def feature_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Up to `bins` - 2 cut points a feature at about equal counts; missing and non-finite values have a bin of their own."""
    shares, found = [(i + 1) / (bins - 1) for i in range(bins - 2)], []
    for at in range(0, len(features), 30):
        some = features[at : at + 30]
        finite = [F.when(~F.isnan(named(f).cast("double")) & (F.abs(named(f).cast("double")) != float("inf")), named(f).cast("double")) for f in some]
        found += rows.agg(*(F.percentile_approx(c, shares, 10 * bins).alias(f"c{i}") for i, c in enumerate(finite))).first()
    return [sorted(set(c or [])) for c in found]


def _bins_of(batch: pa.RecordBatch, features: int, cuts: list[list[float]]) -> np.ndarray:
    out = np.zeros((batch.num_rows, features), np.uint8)
    for i in range(features):
        x = batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(np.float64)
        ok = np.isfinite(x)
        out[ok, i] = np.searchsorted(cuts[i], x[ok], side="left") + 1
    return out


def _binned(rows: DataFrame, model: BoostedTrees) -> DataFrame:
    """Rows (y, w, draw, held, f0..) as STORED, with the scores the model gives so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _bins_of(batch, len(model.features), model.cuts)
            score = _scores(bins, np.tile(model.start, (len(bins), 1)), model.rounds)
            yield _stored(batch, pa.array([r.tobytes() for r in bins], pa.binary()), score)

    return rows.mapInArrow(run, STORED)


def _kept(table: DataFrame) -> DataFrame:
    path = new_table_path(table.sparkSession, "boost-rows")
    table.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _stored(batch: pa.RecordBatch, bins: pa.Array, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([bins, *(batch.column(c) for c in ("y", "w", "draw", "held")), pa.array(list(score), pa.list_(pa.float64()))],
                                      ["bins", "y", "w", "draw", "held", "score"])


def _matrices(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
    score = batch.column("score").flatten().to_numpy(zero_copy_only=False).reshape(len(bins), -1)
    return bins, score


def _scores(bins: np.ndarray, score: np.ndarray, rounds: Sequence[Sequence[Tree]]) -> np.ndarray:
    score = score.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            score[:, k] += np.array(tree.value)[tree.leaf_of(bins)]
    return score


def probabilities(score: np.ndarray) -> np.ndarray:
    """One score a row: that of the second of two classes; else one score a class."""
    if score.shape[1] == 1:
        p = 1 / (1 + np.exp(-np.clip(score, -40, 40)))
        return np.concatenate([1 - p, p], axis=1)
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class _Draw:
    """Gradient-based draw: sizes from `cut` on are all used, others with chance `share` and weight `factor`."""

    cut: float
    share: float
    factor: float
    salt: int


def _scan(table: DataFrame, model: BoostedTrees, recent: Sequence[Sequence[Tree]], trees: Sequence[Tree], open_leaves: Sequence[Sequence[int]],
          losses: bool, sizes: bool, draw: _Draw | None) -> DataFrame:
    """(tree, node, feature, bin, g, h, n): summed gradients of the training rows in every open leaf; losses and sizes on demand."""
    features, bins_n = len(model.features), 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((3, len(o), features, bins_n)) for o in open_leaves]
        extra = np.zeros((2, 2))  # loss and weight of training and held rows
        spread = np.zeros(64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, score = _matrices(batch, features)
            score = _scores(bins, score, recent)
            y, w, held = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "held"))
            p = probabilities(score)
            if losses:
                loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-15))
                for side in (0, 1):
                    mine = held == bool(side)
                    extra[0, side] += np.round(loss[mine] * w[mine] * UNIT).sum()
                    extra[1, side] += np.round(w[mine] * UNIT).sum()
            keep = ~held
            y, w, p, bins = y[keep], w[keep], p[keep], bins[keep]
            target = np.eye(p.shape[1])[y]
            g, h = p - target, np.maximum(p * (1 - p), 1e-6)
            if score.shape[1] == 1:
                g, h = g[:, 1:], h[:, 1:]
            else:
                h = 2 * h  # the classes of a round are grown as if alone, half a step keeps them from overshooting
            size = np.abs(g).sum(axis=1) * w
            if sizes:
                spread += np.bincount(_level(size), minlength=64)
            times = w
            if draw:
                chance = _uniform(batch.column("draw").to_numpy()[keep], draw.salt)
                times = np.where(size >= draw.cut, w, np.where(chance < draw.share, w * draw.factor, 0.0))
            g, h = np.round(g * times[:, None] * UNIT), np.round(h * times[:, None] * UNIT)
            for k, leaves in enumerate(open_leaves):
                if not leaves:
                    continue
                slot = np.full(len(trees[k].feature), -1)
                slot[list(leaves)] = np.arange(len(leaves))
                at = slot[trees[k].leaf_of(bins)]
                mine = np.flatnonzero((at >= 0) & (times > 0))
                for f in range(features):
                    cell = at[mine] * bins_n + bins[mine, f]
                    for i, v in enumerate((g[mine, k], h[mine, k], None)):
                        sums[k][i, :, f, :] += np.bincount(cell, v, len(leaves) * bins_n).reshape(len(leaves), bins_n)
        for k, s in enumerate(sums):
            leaf, f, b = np.nonzero(s[2])
            node = np.array(open_leaves[k] or [0])[leaf]
            values = [np.round(s[i][leaf, f, b]).astype(np.int64) for i in range(3)]
            yield _rows(np.full(len(node), k), node, f, b, *values)
        if losses:
            yield _rows([LOSS] * 2, [0, 1], [0, 0], [0, 0], extra[0].astype(np.int64), extra[1].astype(np.int64), [0, 0])
        if sizes:
            yield _rows([SIZE] * 64, range(64), [0] * 64, [0] * 64, [0] * 64, [0] * 64, spread.astype(np.int64))

    return table.mapInArrow(run, "tree int, node int, feature int, bin int, g bigint, h bigint, n bigint")


def _rows(*columns) -> pa.RecordBatch:
    kinds = [pa.int32()] * 4 + [pa.int64()] * 3
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c), k) for c, k in zip(columns, kinds)], ["tree", "node", "feature", "bin", "g", "h", "n"])


def _level(size: np.ndarray) -> np.ndarray:
    """Bucket of a gradient size: four to each power of two."""
    return np.clip(np.floor(4 * np.log2(np.maximum(size, 1e-9))) + 40, 0, 63).astype(np.int64)


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (key.astype(np.uint64) ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _best_splits(sums: DataFrame, ridge: float, least_rows: int) -> DataFrame:
    """(tree, node, g, h, n, feature, bin, gain, gl, hl): the best split of each leaf; gain is null where there is none.

    Losses and sizes come through as the sums of leaves without a split.
    """
    cell = ["tree", "node", "feature"]
    so_far, whole = W.partitionBy(*cell).orderBy("bin").rowsBetween(W.unboundedPreceding, 0), W.partitionBy(*cell)
    cut = sums.groupBy(*cell, "bin").agg(*(F.sum(c).alias(c) for c in ("g", "h", "n")))
    cut = cut.withColumns({f"{c}l": F.sum(c).over(so_far) for c in ("g", "h", "n")} | {f"{c}t": F.sum(c).over(whole) for c in ("g", "h", "n")})

    def worth(g, h):
        return (g / UNIT) * (g / UNIT) / (h / UNIT + ridge)

    gain = worth(F.col("gl"), F.col("hl")) + worth(F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")) - worth(F.col("gt"), F.col("ht"))
    fits = (F.col("nl") >= least_rows) & (F.col("nt") - F.col("nl") >= least_rows)
    cut = cut.withColumn("gain", F.when(fits & (gain > 1e-9), gain))
    best = F.max_by(F.struct("feature", "bin", "gain", "gl", "hl"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("best")
    return cut.groupBy("tree", "node").agg(*(F.first(f"{c}t").alias(c) for c in ("g", "h", "n")), best).select("tree", "node", "g", "h", "n", "best.*")


def train(rows: DataFrame, features: Sequence[str], label: str, classes: int = 2, held: str | None = None, weight: str | None = None,
          key: str | None = None, rounds: int = 3000, patience: int = 100, step: float = 0.1, depth: int = 6, leaves: int | None = None, at_once: int = 8,
          bins: int = 64, cuts: list[list[float]] | None = None, ridge: float = 1.0, least_rows: int = 1, top_share: float | None = None, rest_share: float = 0.1,
          start: BoostedTrees | None = None, store_every: int = 8) -> BoostedTrees:
    """Boosted trees of `rows` up to the round of the lowest validation loss.

    `held` names a boolean column of the validation rows; training ends when their best round lies `patience` rounds back,
    and without such rows all `rounds` stay. Labels are 0 to `classes` - 1; rows without a label or with a weight that isn't
    positive take no part, and a label out of range is an error. `start` continues a fitted ensemble: its trees stay,
    `rounds` are added. `cuts` may give the ends of the bins; otherwise they are approximate quantiles of the training rows. `key` names the column from which rows are drawn where `top_share` is set.
    """
    if not 4 <= bins <= 256:
        raise ValueError("bins must be from 4 to 256")
    w = (named(weight) if weight else F.lit(1.0)).cast("double")
    y, is_held = named(label).cast("int"), F.coalesce(named(held), F.lit(False)) if held else F.lit(False)
    used = rows.filter(y.isNotNull() & (w > 0) & ~F.isnan(w))
    if not used.filter((y < 0) | (y >= classes)).isEmpty():
        raise ValueError(f"labels must be from 0 to {classes - 1}")
    draw_key = F.xxhash64(named(key)) if key else F.lit(0).cast("long")
    flat = used.select(y.alias("y"), w.alias("w"), draw_key.alias("draw"), is_held.alias("held"), *(named(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)))
    if start is None:
        model = BoostedTrees(list(features), cuts or feature_cuts(used.filter(~is_held), features, bins), classes, _prior(flat, classes))
    else:
        if start.features != list(features) or start.classes != classes:
            raise ValueError("a fitted ensemble is continued with its own features and classes")
        model = BoostedTrees.from_json(start.to_json())
        model.rounds, model.losses, model.train_losses = model.rounds[: model.best_round], model.losses[: model.best_round], model.train_losses[: model.best_round]
    table = _kept(_binned(flat, model))
    stored, last, spread = len(model.rounds), len(model.rounds) + rounds, None

    def scan(trees, open_leaves, first):
        recent = model.rounds[stored:]
        draw = None
        if top_share is not None and spread is not None:
            above = np.cumsum(spread[::-1])[::-1]
            level = int(np.flatnonzero(above >= top_share * above[0])[-1]) if above[0] else 0
            left = max(1e-9, 1 - above[level] / max(above[0], 1))
            share = min(1.0, rest_share / left)
            draw = _Draw(2.0 ** ((level - 40) / 4), share, 1 / share, len(model.rounds) * 7919 + 1)
        return _scan(table, model, recent, trees, open_leaves, first, first and top_share is not None, draw)

    def note(found):
        """Losses of a first scan."""
        loss = {r.node: r.g / r.h if r.h else None for r in found if r.tree == LOSS}
        model.train_losses.append(loss.get(0))
        if loss.get(1) is not None:
            model.losses.append(loss[1])

    def stopped():
        if not model.losses:
            return False
        return len(model.losses) - 1 - int(np.argmin(model.losses)) >= patience

    while len(model.rounds) < last:
        trees = [Tree() for _ in model.start]
        open_leaves: list[list[int]] = [[0] for _ in trees]
        waiting: list[tuple] = []  # (-gain, tree, node, split) of leaves that may still be split
        level, sizes = 0, [1] * len(trees)
        while any(open_leaves):
            found = _best_splits(scan(trees, open_leaves, level == 0), ridge, least_rows).collect()  # a row for each open leaf
            if level == 0:
                note(found)
                spread = np.array([n for _, n in sorted((r.node, r.n) for r in found if r.tree == SIZE)]) if top_share is not None else None
                if stopped():
                    break
            for r in (r for r in found if r.tree >= 0):
                if r.node == 0:
                    trees[r.tree].value[0] = -step * r.g / UNIT / (r.h / UNIT + ridge)
                if r.gain is not None:
                    waiting.append((-r.gain, r.tree, r.node, r))
            waiting.sort(key=lambda x: x[:3])
            open_leaves, later, taken = [[] for _ in trees], [], [0] * len(trees)
            for item in waiting:
                _, k, node, r = item
                if leaves is not None and (sizes[k] >= leaves or taken[k] >= at_once):
                    later.append(item)
                    continue
                values = tuple(-step * g / UNIT / (h / UNIT + ridge) for g, h in ((r.gl, r.hl), (r.g - r.gl, r.h - r.hl)))
                children = trees[k].split(node, r.feature, r.bin, r.gain, values)
                sizes[k] += 1
                taken[k] += 1
                open_leaves[k] += children
            waiting = later if leaves is not None else []
            level += 1
            if leaves is None and level == depth:
                break
            if leaves is not None:
                open_leaves = [o if sizes[k] < leaves else [] for k, o in enumerate(open_leaves)]
        if stopped():
            break
        model.rounds.append(trees)
        if len(model.rounds) - stored == store_every and len(model.rounds) < last:
            table = _kept(_renewed(table, model, model.rounds[stored:]))
            stored = len(model.rounds)
    if len(model.train_losses) == len(model.rounds):  # the last round's losses
        note(scan([Tree() for _ in model.start], [[] for _ in model.start], True).groupBy("tree", "node").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
    model.best_round = int(np.argmin(model.losses)) if model.losses else len(model.rounds)
    return model


def _prior(flat: DataFrame, classes: int) -> list[float]:
    """Scores of the weighted class shares of the training rows, each class counted once more."""
    found = {r.y: r.w for r in flat.filter(~F.col("held")).groupBy("y").agg(F.sum(F.round(F.col("w") * UNIT).cast("long")).alias("w")).collect()}
    share = [found.get(k, 0) / UNIT + 1 for k in range(classes)]
    return [float(np.log(share[1] / share[0]))] if classes == 2 else [float(np.log(s / sum(share))) for s in share]


def _renewed(table: DataFrame, model: BoostedTrees, rounds: Sequence[Sequence[Tree]]) -> DataFrame:
    features = len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, score = _matrices(batch, features)
            yield _stored(batch, batch.column("bins"), _scores(bins, score, rounds))

    return table.mapInArrow(run, STORED)


def score(rows: DataFrame, model: BoostedTrees, out: str = "probs") -> DataFrame:
    """`rows` with the class probabilities of the model's best rounds as an array."""
    cuts, width, rounds, start = model.cuts, len(model.features), model.rounds[: model.best_round], model.start
    inputs = F.array(*(named(f).cast("double") for f in model.features))

    @F.pandas_udf("array<double>")
    def probs(values):
        x = np.array([[np.nan if v is None else v for v in row] for row in values], np.float64).reshape(len(values), width)
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in x.T], [f"f{i}" for i in range(width)])
        bins = _bins_of(batch, width, cuts)
        return values.__class__(list(probabilities(_scores(bins, np.tile(start, (len(bins), 1)), rounds))))

    return rows.withColumn(out, probs(inputs))
