"""Language of texts by a linear-chain conditional random field over words.

Each word that has a letter is a place of the chain; its features are the word itself, its
beginnings and endings of one to four letters, its letter pairs and triples, and the
languages in whose lexicon (frequent words of the sample) it stands. Feature weights are
kept in `buckets` hashed rows, transitions between the languages of neighbouring words
are learned with them, from windows of the sample half of which switch language in the middle.
Forward-backward gives each word its distribution over languages; a text has the
language of the largest sum, and its share is the score.

A text is one chain, however long. It is worked on in blocks of `CHAIN` words at once: the product of
a block's potentials carries the messages over it, from the text's start and from its end, so that each
word has the posterior of the whole chain while memory holds a block at a time for each of many texts.

The sample is bounded: `per_language` texts of up to `sample_chars` characters, and
`language_chars` characters together, for each of the `most_languages` most frequent languages, the lowest by hash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.llm.common import held_out, slices, tidy
from flowloom.llm.near_dedup import GOLD, mix
from flowloom.session import settle

CHAIN = 128
WINDOW = 32
LEXICON = 200
KEPT = 100_000  # words, and forty times as many characters
UNKNOWN = "und"


def letters_of(word: str) -> str:
    """The letters of a word in lower case; fractions, superscripts and Roman numeral signs are none."""
    w = word.lower()
    return w if w.isalpha() else "".join(filter(str.isalpha, w))


def features(words: list[str], lexica: dict[str, tuple[int, ...]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of many words at once (letters only, not empty): all in a row, and where each word's begin."""
    sizes = np.array([len(w) + 2 for w in words])
    code = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    every = np.arange(len(words))
    start, owner = np.cumsum(sizes) - sizes, np.repeat(every, sizes)
    place = np.arange(len(code)) - start[owner]
    left = sizes[owner] - place
    of, hashed = [], []

    def put(who: np.ndarray, value: np.ndarray, kind: int) -> None:
        of.append(who)
        hashed.append(mix(value + np.uint64(kind) * GOLD))

    with np.errstate(over="ignore"):
        put(every, np.add.reduceat(mix(code + place.astype(np.uint64) * GOLD), start), 1)  # the word
        pair = mix(code[:-1] * GOLD + code[1:])
        fit = left[:-1] >= 2
        put(owner[:-1][fit], pair[fit], 2)
        fit = left[:-2] >= 3
        put(owner[:-2][fit], (pair[:-1] * GOLD + code[2:])[fit], 3)
        for sign, edge in ((1, start + 1), (-1, start + sizes - 2)):  # beginnings and endings
            value = np.zeros(len(words), np.uint64)
            for k in range(4):
                long = np.flatnonzero(sizes - 2 > k)
                value[long] = mix(value[long] * GOLD + code[edge[long] + sign * k])
                put(long, value[long], 10 + k + (4 if sign < 0 else 0))
        listed = [(i, y) for i, w in enumerate(words) for y in lexica.get(w, ())]
        if listed:
            put(np.array([i for i, _ in listed]), np.array([y for _, y in listed], np.uint64), 30)
    who = np.concatenate(of)
    order = np.argsort(who, kind="stable")
    flat = (np.concatenate(hashed)[order] % np.uint64(buckets)).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(words)))])


def forward_backward(emission: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors [chain, place, language] and expected transitions [language, language].

    emission, start and step are positive potentials; places from a chain's length on are padding.
    """
    n, most, size = emission.shape
    alpha, beta = np.empty_like(emission), np.ones_like(emission)
    a = emission[:, 0] * start
    alpha[:, 0] = a / a.sum(1, keepdims=True)
    for t in range(1, most):
        a = (alpha[:, t - 1] @ step) * emission[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    for t in range(most - 2, -1, -1):
        b = (beta[:, t + 1] * emission[:, t + 1]) @ step.T
        b /= b.sum(1, keepdims=True)
        beta[:, t] = np.where((t + 1 < lengths)[:, None], b, 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    moves = np.zeros((size, size))
    for t in range(most - 1):
        live = t + 1 < lengths
        if live.any():
            pair = alpha[live, t, :, None] * step[None] * (emission[live, t + 1] * beta[live, t + 1])[:, None, :]
            moves += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
    return gamma, moves


def posteriors(emission: np.ndarray, lengths: np.ndarray, first: np.ndarray, step: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
    """As forward_backward, without the transitions, for stretches of chains.

    first [chain, language] is what arrives at the first place (start, or the message of the place before by `step`), last
    [chain, language] the message from behind the last place; of the whole chains' ends, ones. Padding is ones.
    """
    most = emission.shape[1]
    alpha = np.empty_like(emission)
    a = emission[:, 0] * first
    alpha[:, 0] = a / a.sum(1, keepdims=True)
    for t in range(1, most):
        a = (alpha[:, t - 1] @ step) * emission[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    ends, back = np.ones_like(alpha[:, 0]) if last is None else last, step.T.copy()
    beta = ends
    alpha[:, most - 1] *= beta
    for t in range(most - 2, -1, -1):
        b = (beta * emission[:, t + 1]) @ back
        b /= b.sum(1, keepdims=True)
        beta = np.where((t + 1 < lengths)[:, None], b, ends).astype(alpha.dtype)
        alpha[:, t] *= beta
    alpha /= alpha.sum(2, keepdims=True)
    return alpha


def products(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """[stretch, language before, language of its last place]: potentials of a way through the stretch, to a factor."""
    n, most, size = emission.shape
    out = np.broadcast_to(np.eye(size, dtype=emission.dtype), (n, size, size)).copy()
    for t in range(most):
        live = t < lengths
        moved = (out[live].reshape(-1, size) @ step).reshape(-1, size, size) * emission[live, t, None, :]
        out[live] = moved / moved.sum((1, 2), keepdims=True)
    return out


def chain_sums(table: np.ndarray, texts: list[np.ndarray], start: np.ndarray, step: np.ndarray, together: int = 512) -> np.ndarray:
    """[text, language]: posteriors summed over the words of each text, whose potentials are the rows `texts` of `table`."""
    size = table.shape[1]
    sums, narrow = np.zeros((len(texts), size)), step.astype(np.float32)
    owner = np.repeat(np.arange(len(texts)), [-(-len(r) // CHAIN) for r in texts])
    block = [r[k : k + CHAIN] for r in texts for k in range(0, len(r), CHAIN)]
    if not block:
        return sums
    lengths = np.array([len(b) for b in block])
    head = np.concatenate([[True], owner[1:] != owner[:-1]])
    tail = np.append(head[1:], True)

    def padded(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        live = np.arange(lengths[part].max())[None, :] < lengths[part][:, None]
        places = np.zeros(live.shape, np.int64)
        places[live] = np.concatenate([block[i] for i in part])
        return np.where(live[:, :, None], table[places], np.float32(1)), live

    first = np.broadcast_to(start, (len(block), size)).astype(np.float32)
    last = np.ones((len(block), size), np.float32)
    many = np.flatnonzero(~(head & tail))  # blocks of texts of more than one
    if len(many):
        over = np.zeros((len(block), size, size))
        over_of = np.where(head, lengths - 1, lengths)  # a first block is entered behind its first place, from its potentials
        for at in range(0, len(many), together):
            part = many[at : at + together]
            emission, _ = padded(part)
            for mine, from_ in ((head[part], 1), (~head[part], 0)):
                if mine.any():
                    over[part[mine]] = products(emission[mine, from_:], over_of[part[mine]], narrow)
        for i in many:  # messages from block to block
            if head[i]:
                message = start * table[block[i][0]]
            message = message @ over[i]
            message /= message.sum()
            if not tail[i]:
                first[i + 1] = message @ step
        for i in many[::-1]:
            if tail[i]:
                message = np.ones(size)
            last[i] = message
            message = over[i] @ message
            message /= message.sum()
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(order), together):
        part = order[at : at + together]
        emission, live = padded(part)
        gamma = posteriors(emission, lengths[part], first[part], narrow, last[part])
        np.add.at(sums, owner[part], (gamma * live[:, :, None]).sum(1, dtype=np.float64))
    return sums


@dataclass
class Model:
    languages: list[str]
    buckets: int
    lexica: dict[str, tuple[int, ...]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 1)))
    start: np.ndarray = field(default_factory=lambda: np.ones(1))
    step: np.ndarray = field(default_factory=lambda: np.ones((1, 1)))
    known: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))
    chars: int = 0

    def potentials(self, logs: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(logs - logs.max(-1, keepdims=True), -30, 0))

    def add(self, words: set[str]) -> None:
        """Rows of the table for new words, -1 for those without a letter."""
        plain = {w: letters_of(w) for w in words}
        fresh = sorted({x for x in plain.values() if x and x not in self.rows})
        if fresh:
            flat, firsts = features(fresh, self.lexica, self.buckets)
            table = self.potentials(np.add.reduceat(self.weights[flat], firsts[:-1])).astype(np.float32)
            self.rows.update(zip(fresh, range(len(self.table), len(self.table) + len(fresh))))
            self.table = np.concatenate([self.table, table])
        self.known.update((w, self.rows[x] if x else -1) for w, x in plain.items())
        self.chars += sum(map(len, plain))

    def places(self, words: list[str]) -> np.ndarray:
        """Rows of the table for the words with letters, in order."""
        if fresh := set(words).difference(self.known):
            self.add(fresh)
        found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return found[found >= 0]

    def reset(self) -> None:
        """Forgets the words met, which cost time and no results."""
        self.known.clear()
        self.rows.clear()
        self.table = self.table[:0].copy()
        self.chars = 0

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        if len(self.known) >= KEPT or self.chars >= 40 * KEPT:
            self.reset()
        words = [t.split() if t else [] for t in texts]
        self.add(set(chain.from_iterable(words)).difference(self.known))
        out = []
        for s in chain_sums(self.table, [self.places(ws) for ws in words], self.start, self.step):
            total = s.sum()
            out.append((self.languages[int(s.argmax())], float(min(1.0, s.max() / total))) if total > 0 else (UNKNOWN, 0.0))
        return out


def fit(samples: list[tuple[str, str]], buckets: int = 1 << 16, epochs: int = 5, rate: float = 0.3, windows: int = 10_000) -> Model:
    """Field from (language, text) pairs, by Adagrad on the likelihood of the windows."""
    languages = sorted({lang for lang, _ in samples})
    model = Model(languages, buckets)
    if not languages:
        return model
    size, rng = len(languages), np.random.default_rng(8)
    of = {lang: i for i, lang in enumerate(languages)}
    counts: dict[int, Counter] = defaultdict(Counter)
    pieces: dict[int, list[list[str]]] = defaultdict(list)
    for lang, text in samples:
        words = [w for w in text.split() if any(c.isalpha() for c in w)]
        counts[of[lang]].update(map(letters_of, words))
        pieces[of[lang]] += [words[k : k + WINDOW] for k in range(0, len(words), WINDOW)]
    lexica: dict[str, list[int]] = defaultdict(list)
    for y, c in counts.items():
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexica[w].append(y)
    model.lexica = {w: tuple(sorted(y)) for w, y in lexica.items()}
    each = max(1, windows // size)
    chosen = [(y, p) for y in sorted(pieces) for p in (pieces[y][i] for i in rng.permutation(len(pieces[y]))[:each])]
    if not chosen:
        return model
    order = rng.permutation(len(chosen))
    chains = []
    for k, i in enumerate(order):
        y, words = chosen[i]
        y2, words2 = chosen[order[(k + 1) % len(order)]]
        if k % 2:  # switches language in the middle
            half = WINDOW // 2
            words, tags = words[:half] + words2[:half], [y] * len(words[:half]) + [y2] * len(words2[:half])
        else:
            tags = [y] * len(words)
        chains.append((words, tags))
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in chains for w in words))}
    flat, firsts = features([letters_of(w) for w in vocabulary], model.lexica, buckets)
    weights, gain = np.zeros((buckets, size)), np.full((buckets, size), 1e-6)
    step, step_gain = np.zeros((size, size)), np.full((size, size), 1e-6)
    start, start_gain = np.zeros(size), np.full(size, 1e-6)
    for _ in range(epochs):
        for at in range(0, len(chains), 500):
            part = chains[at : at + 500]
            lengths = np.array([len(w) for w, _ in part])
            live = np.arange(lengths.max())[None, :] < lengths[:, None]
            ids = np.array([vocabulary[w] for words, _ in part for w in words])
            tags = np.array([y for _, ys in part for y in ys])
            own, back = np.unique(ids, return_inverse=True)
            sizes = firsts[own + 1] - firsts[own]
            feats = np.concatenate([flat[firsts[i] : firsts[i + 1]] for i in own])
            logs = np.add.reduceat(weights[feats], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            emission = np.ones((len(part), lengths.max(), size))
            emission[live] = model.potentials(logs)[back]
            gamma, moves = forward_backward(emission, lengths, np.exp(start), np.exp(step))
            wrong = np.eye(size)[tags] - gamma[live]
            by_word = np.zeros((len(own), size))
            np.add.at(by_word, back, wrong)
            change = np.zeros_like(weights)
            np.add.at(change, feats, np.repeat(by_word, sizes, axis=0))
            real, first = np.zeros((size, size)), np.zeros(size)
            tag_table = np.full(live.shape, -1)
            tag_table[live] = tags
            ahead = live[:, 1:]
            np.add.at(real, (tag_table[:, :-1][ahead], tag_table[:, 1:][ahead]), 1)
            np.add.at(first, tag_table[:, 0], 1)
            for value, total, grad in ((weights, gain, change / len(part)), (step, step_gain, (real - moves) / len(part)),
                                       (start, start_gain, (first - gamma[:, 0].sum(0)) / len(part))):
                total += grad * grad
                value += rate * grad / np.sqrt(total)
    model.weights, model.start, model.step = weights.astype(np.float32), np.exp(start), np.exp(step)
    model.table = np.zeros((0, size), np.float32)
    return model


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = 400,
          sample_chars: int = 100_000, language_chars: int = 4_000_000, most_languages: int = 64) -> Model:
    """Field from documents outside the held-out fold that have a language; the last four parameters bound the sample.

    Languages beyond the `most_languages` that most texts have are not learned.
    """
    rows = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & (F.length(text_col).between(1, sample_chars))).select(
        F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.length(text_col).alias("n_chars"), F.col(text_col).alias("text"))
    # ranked by part of a language first, so that no task ranks all texts of one
    lowest = W.partitionBy("lang", F.pmod("h", F.lit(64))).orderBy(F.xxhash64("h"), "h")
    first = settle(rows.groupBy("lang", "h").agg(F.count("*").alias("texts"), F.max("n_chars").alias("n_chars"))
                   .withColumn("n", F.row_number().over(lowest)).withColumn("texts", F.sum("texts").over(W.partitionBy("lang", F.pmod("h", F.lit(64)))))
                   .filter(F.col("n") <= per_language), "language-lowest")
    common = (first.filter(F.col("n") == 1).groupBy("lang").agg(F.sum("texts").alias("texts"))
              .orderBy(F.col("texts").desc(), "lang").limit(most_languages).select("lang"))
    every = W.partitionBy("lang").orderBy(F.xxhash64("h"), "h")
    # written, so that its size is known and the texts are not shuffled to join it
    wanted = settle(first.join(common, "lang").withColumn("n", F.row_number().over(every))
                    .withColumn("upto", F.sum("n_chars").over(every.rowsBetween(W.unboundedPreceding, 0)))
                    .filter((F.col("n") <= per_language) & (F.col("upto") <= language_chars)).select("lang", "h"), "language-sample")
    chosen = rows.join(wanted, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    return fit([(r["lang"], r["text"]) for r in sorted(chosen, key=lambda r: (r["lang"], r["h"]))])


def predict_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, held_out, lang_pred, score.

    A null text, or one without a letter, is `und` with score 0, as is any text if nothing was
    learned. Repeated rows stay; only id and text are read, and the id is not
    used for the prediction. There is no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch, 2):
                found = own.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()),
                                                  pa.array([f[1] for f in found], pa.float64())], ["id", "held_out", "lang_pred", "score"])
        own.reset()

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """The rows of `docs`, with all their columns, that have a language of at least this score."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch, at):
                found = own.predict(part.column(at).to_pylist())
                yield part.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score in found], pa.bool_()))
        own.reset()

    return docs.mapInArrow(tidy(run), docs.schema)
