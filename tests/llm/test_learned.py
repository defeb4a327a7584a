import itertools
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.llm import common, language_id, toxicity


def fold(i):
    return crc32(str(i).encode()) % 4 == 2


def test_held_out_fold(spark):
    df = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", common.held_out(F.col("doc_id"))).collect()}
    assert all(got[i] == fold(i) for i in range(200)) and got[None] is False


def test_forward_backward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(3)
    start, step = rng.random(3) + 0.1, rng.random((3, 3)) + 0.1
    emission, lengths = rng.random((4, 5, 3)) + 0.05, np.array([5, 3, 1, 4])
    gamma, moves = language_id.forward_backward(emission, lengths, start, step)
    want_moves = np.zeros((3, 3))
    for c, n in enumerate(lengths):
        total, marginal, pairs = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = start[path[0]] * np.prod([emission[c, t, y] for t, y in enumerate(path)]) * np.prod([step[a, b] for a, b in zip(path, path[1:])])
            total += p
            for t, y in enumerate(path):
                marginal[t, y] += p
            for a, b in zip(path, path[1:]):
                pairs[a, b] += p
        assert gamma[c, :n] == pytest.approx(marginal / total)
        want_moves += pairs / total
    assert moves == pytest.approx(want_moves)
    padded = emission.copy()
    padded[np.arange(5)[None, :] >= lengths[:, None]] = 1
    again = language_id.posteriors(padded, lengths, start, step)
    for c, n in enumerate(lengths):
        assert again[c, :n] == pytest.approx(gamma[c, :n])


def test_long_chains_are_not_cut():
    rng = np.random.default_rng(5)
    size = 4
    table = (rng.random((50, size)) ** 4 + 1e-6).astype(np.float32)
    start, step = rng.random(size) + 0.1, rng.random((size, size)) + np.eye(size) * 3
    cut = language_id.CHAIN
    texts = [rng.integers(0, 50, n) for n in (0, 1, 5, cut - 1, cut, cut + 1, 2 * cut, 2 * cut + 1, 11 * cut + 17, 0, 3)]
    got = language_id.chain_sums(table, texts, start, step, together=3)
    for sums, places in zip(got, texts):
        want = np.zeros(size)
        if len(places):
            want = language_id.forward_backward(table[places][None].astype(float), np.array([len(places)]), start, step)[0][0].sum(0)
        assert sums == pytest.approx(want, rel=1e-3, abs=1e-3)
    # words without a sign of their own take the language of the words on both sides, however far away the blocks are cut
    plain = np.vstack([np.ones(2), [1, 1e-9], [1e-9, 1]]).astype(np.float32)
    keep = np.array([[1, 1e-4], [1e-4, 1]])
    for sign in (1, 2):
        text = np.zeros(cut + 40, np.int64)
        text[cut + 30] = sign
        share = language_id.chain_sums(plain, [text], np.ones(2), keep)[0] / len(text)
        assert share[sign - 1] > 0.98


def test_the_language_sample_is_bounded(spark):
    rows = [(i, "abcdefgh"[i % 8] * 2, f"word{chr(97 + i % 26)} text{chr(97 + i // 26 % 26)} {chr(97 + i % 7) * 5}") for i in range(400)]
    rows += [(1000 + i, "zz", "rare words") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert language_id.learn(docs).languages == [c * 2 for c in "abcdefgh"] + ["zz"]
    assert language_id.learn(docs, most_languages=8).languages == [c * 2 for c in "abcdefgh"]
    assert language_id.learn(docs, language_chars=5).languages == []


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 9, None, "b" * 50, "", "c" * 9, "d"])], ["i", "t"])
    assert [p.column(0).to_pylist() for p in common.slices(batch, 1, 3, 20)] == [[0, 1], [2], [3, 4, 5]]
    assert list(common.slices(batch.slice(0, 0), 1)) == []


def test_languages_held_out_and_edge_cases(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.learn(docs, per_language=60)
    real = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language_id.predict_languages(docs, model).collect()
    assert len(got) == len(real)
    held = [r for r in got if r.held_out]
    assert held and all(fold(r.doc_id) == r.held_out for r in got)
    assert sum(r.lang_pred == real[r.doc_id] for r in held) / len(held) > 0.98
    texts = [(1, None), (2, ""), (3, "123 ... !!"), (4, "the of and to"), (4, "the of and to"), (None, "la de que les des"), (5, "the of and " * 30_000)]
    odd = spark.createDataFrame([(i, t, "xx", 1.0) for i, t in texts], "doc_id long, text string, lang_pred string, score double")
    pred = [(r.doc_id, r.lang_pred) for r in language_id.predict_languages(odd, model).collect()]
    assert pred == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "fr"), (5, "en")]
    assert [r.doc_id for r in language_id.keep_identified(odd, model).collect()] == [4, 4, None, 5]
    half = "the of and this " * 8 + "la de que les " * 8
    rows = model.places(half.split())
    gamma = language_id.posteriors(model.table[rows][None], np.array([len(rows)]), model.start, model.step)[0]
    words = [model.languages[i] for i in gamma.argmax(1)]
    assert words[:30].count("en") > 28 and words[-30:].count("fr") > 28  # words of a text that switches
    assert language_id.predict_languages(odd, language_id.learn(docs.limit(0))).filter("lang_pred <> 'und'").count() == 0
    assert language_id.predict_languages(odd.limit(0), model).count() == 0


@pytest.mark.parametrize("text", ["² ½", "Ⅳ ①", "x²" , "١٢٣ ٤", "_ 3.5%"])
def test_only_letters_count_as_letters(text):
    assert "".join(map(language_id.letters_of, text.split())) == ("x" if "x" in text else "")


@pytest.fixture(scope="module")
def toxic(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    return docs.join(labels.select("doc_id"), "doc_id"), labels, toxicity.learn(docs, labels)


def test_nearest_is_exact(toxic):
    docs, _, model = toxic
    counts = [model.counts(r.text) for r in docs.limit(300).collect()]
    vectors = []
    for e in range(len(model.ids)):  # back from the postings
        vectors.append({})
    v, blocks = model.largest.shape
    for t in range(v):
        for p in range(model.pointer[t * blocks], model.pointer[(t + 1) * blocks]):
            vectors[model.posted[p]][t] = model.weight[p]
    for c in {tuple(sorted(c.items())) for c in counts}:
        at, w = model.vector(Counter(dict(c)))
        who, cosine = model.nearest(at, w)
        q = dict(zip(at.tolist(), w))
        every = sorted(((-round(sum(x * e.get(t, 0) for t, x in q.items()), 12), i) for i, e in enumerate(vectors)))
        want = [(i, -s) for s, i in every if s < 0][: model.neighbours]
        assert cosine == pytest.approx([s for _, s in want], abs=1e-9)


def test_toxicity_held_out(toxic):
    docs, labels, model = toxic
    real = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.score_texts(docs, model).collect()
    held = [(r.score, r.predicted, real[r.doc_id]) for r in got if r.held_out]
    assert all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in held)
    hit = sum(p and y for _, p, y in held)
    assert hit / sum(y for *_, y in held) > 0.88 and hit / sum(p for _, p, _ in held) > 0.9
    assert len(toxicity.keep_clean(docs, model).collect()) == sum(r.predicted == 0 for r in got)


def test_toxicity_edge_cases(spark, toxic):
    docs, labels, model = toxic
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "idiot clown trash moron scum", 5), (3, "idiot clown trash moron scum", 5), (None, "fine words", 5), (4, "fine " * 50_000, 5)],
                                "doc_id long, text string, score int")
    got = toxicity.score_texts(odd, model).collect()
    assert [(r.doc_id, r.predicted) for r in got] == [(1, 0), (2, 0), (3, 1), (3, 1), (None, 0), (4, 0)]
    assert got[2].nearest_id is not None and got[2].nearest_cosine > 0.3
    none = toxicity.learn(docs.limit(0), labels)
    assert all(0 <= r.score <= 1 and r.predicted == 0 for r in toxicity.score_texts(odd, none).collect())
    assert all(r.predicted == 0 for r in toxicity.score_texts(odd, toxicity.learn(docs, labels.limit(0))).collect())
    assert toxicity.score_texts(odd.limit(0), model).count() == 0


def test_insults_of_a_small_share_are_terms(spark):
    rng = np.random.default_rng(5)
    plain = [f"{a}{b}" for a in ("wal", "tor", "min", "sed", "lun") for b in ("ka", "ro", "ti", "su", "pe", "no")]
    rows = []
    for i in range(10_000):
        insult = [] if i % 2 else ["zorgle" if i % 200 == 0 else "blagge"]
        rows.append((i, " ".join([*rng.choice(plain, 12), *insult]), 1 - i % 2))
    rare = [i for i, t, _ in rows if "zorgle" in t][:40]  # under 1 % of the toxic texts
    rows = [r for r in rows if "zorgle" not in r[1] or r[0] in rare]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert {"zorgle", "blagge"} <= set(model.terms)
    got = {r.doc_id: r for r in toxicity.score_texts(docs.select("doc_id", "text"), model).collect()}
    held = [got[i].predicted for i in rare if fold(i)]
    assert held and all(held) and not any(got[i].predicted for i, _, y in rows if not y)
