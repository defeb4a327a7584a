"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and the proper beginnings of 5 and 7 letters of longer
words; all words without a kept term count as one more term of weight `plain_weight`, so
that a single mention in a long text is near to texts without any. From a bounded, hash-chosen sample of labelled texts (`per_class` of either
label, each different text once) the terms that go with the label are kept: those
in 4 toxic texts or more whose share there is `least_lift` times that among clean texts or more,
by `z` standard errors or more; a large sample would else keep words of any small difference. No share of
the toxic texts is asked for, so insults of a small language or source are terms too. Half of the sample are the examples, half calibrate.

The examples form a block-max inverted index: postings by term, examples in blocks of 64,
with the largest weight of each term in each block. The bounds that a text's weights and the block
maxima give order the blocks; the k-th best cosine in the two best ones rules out blocks
with a bound under it, the rest are scored, so the k nearest are exact. They vote
with their cosine, weighted back to the share of the classes among all labels, with
one clean vote of `prior_votes` beside them. An isotonic fit on the other half turns
votes into probabilities. The nearest example and its cosine are the evidence.

Learning reads ids and hashes of all texts, and the texts of the sample only; the
model is bounded by `per_class` and `vocabulary`, and is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import held_out, tidy
from flowloom.session import settle

_WORD = re.compile(r"[^\W\d_]+")
STEMS = (5, 7)
BLOCK = 64
KEPT = 100_000


def terms_of(word: str) -> list[str]:
    return [word, *(word[:k] + "+" for k in STEMS if len(word) > k)]


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray
    neighbours: int
    clean_vote: float
    #: Postings by (term, block): examples and their normalised weights; the largest weight of each.
    pointer: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    posted: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    largest: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    label: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vote: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: list = field(default_factory=list)
    steps: np.ndarray = field(default_factory=lambda: np.zeros(1))
    shares: np.ndarray = field(default_factory=lambda: np.zeros(1))
    words: dict[str, tuple[int, ...]] = field(default_factory=dict)
    plain: tuple[float, object, float] | None = None

    def counts(self, text: str | None) -> Counter:
        """How often each kept term stands in a text; last, how many words have none."""
        found: Counter = Counter()
        known, words = self.words, _WORD.findall(text.lower()) if text else []
        got = list(map(known.get, words))
        if None in got:
            if len(known) >= KEPT:
                known.clear()
            for i, g in enumerate(got):
                if g is None:
                    got[i] = known.get(words[i])
                    if got[i] is None:
                        got[i] = known[words[i]] = tuple(self.terms[t] for t in terms_of(words[i]) if t in self.terms)
        plain = got.count(())
        for g in filter(None, got) if plain < len(got) else ():
            for t in g:
                found[t] += 1
        if plain:
            found[len(self.terms)] = plain
        return found

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms and their weights, of length one."""
        at = np.array(sorted(counts), dtype=np.int64)
        w = (1 + np.log([counts[t] for t in at])) * self.idf[at] if len(at) else np.zeros(0)
        size = np.linalg.norm(w)
        return at, w / size if size else w

    def index(self, examples: list[tuple[object, int, Counter]], weights: tuple[float, float]) -> None:
        same: Counter = Counter()
        first = []  # of examples with equal vectors only the first k can be among the k nearest
        for e in examples:
            key = tuple(sorted(e[2].items())) if set(e[2]) != {len(self.terms)} else "plain"
            same[key] += 1
            if same[key] <= self.neighbours:
                first.append(e)
        examples = first
        vectors = [self.vector(c) for _, _, c in examples]
        self.ids, self.label = [e[0] for e in examples], np.array([e[1] for e in examples], dtype=float)
        self.vote = np.where(self.label == 1, weights[1], weights[0])
        blocks, v = -(-len(examples) // BLOCK), len(self.idf)
        term = np.concatenate([a for a, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        who = np.repeat(np.arange(len(vectors)), [len(a) for a, _ in vectors])
        w = np.concatenate([b for _, b in vectors] or [np.zeros(0)])
        order = np.lexsort((who, term))
        term, who, w = term[order], who[order], w[order]
        cell = term * blocks + who // BLOCK
        self.pointer = np.searchsorted(cell, np.arange(v * blocks + 1))
        self.posted, self.weight = who.astype(np.int32), w
        self.largest = np.zeros(v * blocks)
        np.maximum.at(self.largest, cell, w)
        self.largest = self.largest.reshape(v, blocks)

    def nearest(self, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the highest cosine above 0, ties to the first; exact."""
        blocks, k = self.largest.shape[1] if self.largest.ndim == 2 else 0, self.neighbours
        if not len(at) or not blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = w @ self.largest[at]
        scores = np.zeros(blocks * BLOCK)
        seen = np.argsort(-bound, kind="stable")[:2]
        for b in sorted(seen.tolist()):
            self._add(scores, at, w, b, b + 1)
        floor = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else 0.0
        open_ = bound >= max(floor - 1e-9, 1e-12)  # the k-th best so far bounds what can still be among the k nearest
        open_[seen] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[0], open_.view(np.int8), [0]])))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):  # blocks in a row at once
            self._add(scores, at, w, lo, hi)
        hit = np.flatnonzero(scores > 0)
        if len(hit) > k:
            hit = hit[scores[hit] >= np.partition(scores[hit], len(hit) - k)[len(hit) - k] - 1e-9]
        hit = hit[np.lexsort((hit, -np.round(scores[hit], 12)))][:k]
        return hit, scores[hit]

    def _add(self, scores: np.ndarray, at: np.ndarray, w: np.ndarray, first: int, end: int) -> None:
        """Weights of blocks first to end - 1, onto their examples' scores."""
        blocks = self.largest.shape[1]
        for t, x in zip(at.tolist(), w.tolist()):
            lo, hi = self.pointer[t * blocks + first], self.pointer[t * blocks + end]
            scores[self.posted[lo:hi]] += x * self.weight[lo:hi]

    def votes(self, counts: Counter) -> tuple[float, object, float]:
        """Share of toxic votes, and the id and cosine of the nearest example."""
        if len(counts) == 1 and len(self.terms) in counts:  # plain words only: one direction, however many
            counts = Counter({len(self.terms): 1})
            if self.plain is not None:
                return self.plain
            self.plain = self.judged(counts)
            return self.plain
        return self.judged(counts)

    def judged(self, counts: Counter) -> tuple[float, object, float]:
        if not counts:
            return 0.0, None, 0.0
        who, cosine = self.nearest(*self.vector(counts))
        if not len(who):
            return 0.0, None, 0.0
        v = cosine * self.vote[who]
        return float((v * self.label[who]).sum() / (v.sum() + self.clean_vote)), self.ids[who[0]], float(min(1.0, cosine[0]))

    def calibrate(self, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Isotonic fit of the label to the vote, by pooling neighbours that fall."""
        pools: list[list[float]] = []
        for x in np.unique(votes):
            here = votes == x
            pools.append([x, (weights * labels)[here].sum(), weights[here].sum()])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1][1] += last[1]
                pools[-1][2] += last[2]
        self.steps = np.array([p[0] for p in pools])
        self.shares = np.array([(p[1] + 0.01) / (p[2] + 0.1) for p in pools])
        self.shares = np.maximum.accumulate(self.shares)

    def score(self, text: str | None) -> tuple[float, object, float]:
        vote, near, cosine = self.votes(self.counts(text))
        at = max(0, int(np.searchsorted(self.steps, vote, "right")) - 1)
        if at + 1 < len(self.steps):  # between the steps, in a straight line
            lo, hi = self.steps[at], self.steps[at + 1]
            share = self.shares[at] + (self.shares[at + 1] - self.shares[at]) * min(1.0, max(0.0, (vote - lo) / (hi - lo)))
        else:
            share = self.shares[-1]
        return float(min(1.0, max(0.0, share))), near, cosine


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = 6000, vocabulary: int = 4096, z: float = 5.0, least_lift: float = 3.0, neighbours: int = 15,
          prior_votes: float = 0.2, plain_weight: float = 0.75) -> Model:
    """Model from the labelled texts outside the held-out fold; per_class bounds the sample."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    judged = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(F.col("y").isin(0, 1))
              .filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    known = settle(rows.select("id", F.xxhash64("text").alias("h")).join(judged, "id")
                   .groupBy("h").agg(F.max("y").alias("y"), F.min("id").alias("id")), "toxic-known")
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("h"), "h").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = settle(chosen, "toxic-chosen")
    sample = settle(rows.join(chosen, "id").filter(F.xxhash64("text") == F.col("h")).dropDuplicates(["h"])
                    .select("id", "h", "y", "text"), "toxic-sample")
    taken = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = taken.get(0, 0), taken.get(1, 0)

    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    stems = [F.transform(F.filter(words, lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("+"))) for k in STEMS]
    in_texts = sample.select("y", F.explode(F.array_distinct(F.concat(words, *stems))).alias("term"))
    counted = in_texts.groupBy("term").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    share = (F.col("t") + F.col("c") + 1) / (n0 + n1 + 2)
    strength = F.abs(F.col("t") / max(1, n1) - F.col("c") / max(1, n0)) / F.sqrt(share * (1 - share) * (1 / max(1, n0) + 1 / max(1, n1)))
    lift = (F.col("t") + 0.5) / max(1, n1) >= least_lift * (F.col("c") + 0.5) / max(1, n0)
    kept = (counted.withColumn("z", strength).filter((F.col("z") >= z) & lift & (F.col("t") >= 4))
            .orderBy(F.col("z").desc(), "term").limit(vocabulary).collect())
    idf = np.append(np.log((1 + n0 + n1) / np.array([1 + r["t"] + r["c"] for r in kept], dtype=float)), plain_weight)
    model = Model({r["term"]: i for i, r in enumerate(kept)}, idf, neighbours, prior_votes)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.counts(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("h"), batch.column("y"), pa.array([list(c) for c in found], pa.list_(pa.int32())),
                pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["id", "h", "y", "terms", "times"])

    id_type = rows.schema["id"].dataType.simpleString()
    read = sorted(sample.mapInArrow(vectors, f"id {id_type}, h long, y int, terms array<int>, times array<int>").collect(), key=lambda r: r["h"])
    as_row = [(r["id"], r["y"], Counter(dict(zip(r["terms"], r["times"])))) for r in read]
    weights = tuple(total.get(y, 0) / max(1, taken.get(y, 0)) for y in (0, 1))
    scale = sum(weights[r[1]] for r in as_row) / max(1, len(as_row)) or 1.0
    weights = (weights[0] / scale, weights[1] / scale)
    examples, others = as_row[::2], as_row[1::2]
    # examples of like terms stand together, so that blocks differ
    examples.sort(key=lambda r: (sorted(r[2], key=lambda t: (-idf[t] * r[2][t], t))[:2], str(r[0])))
    model.index(examples, weights)
    if others:
        model.calibrate(np.array([model.votes(r[2])[0] for r in others]), np.array([r[1] for r in others], dtype=float),
                        np.array([weights[r[1]] for r in others]))
    model.words = {}
    return model


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row of `docs`: id, held_out, score, predicted, nearest_id, nearest_cosine.

    Null and empty texts, and texts without a kept term, have the calibrated share of toxic
    texts among such. Without labels every score is 0. Repeated rows stay; only
    id and text are read, and the id is not used for the score. There is no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = [own.score(t.as_py()) for t in batch.column(2)]
            scores = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                pa.array([f[1] for f in found], batch.column(0).type), pa.array([f[2] for f in found], pa.float64())],
                ["id", "held_out", "score", "predicted", "nearest_id", "nearest_cosine"])
        own.words.clear()

    out = rows.mapInArrow(run, f"id {id_type}, held_out boolean, score double, predicted int, nearest_id {id_type}, nearest_cosine double")
    return out.withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score is under the threshold."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py())[0] < threshold for t in batch.column(at)], pa.bool_()))
        own.words.clear()

    return docs.mapInArrow(tidy(run), docs.schema)
