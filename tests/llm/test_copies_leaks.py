import random
from collections import Counter

import numpy as np
import pytest

from flowloom.llm import common, decontaminate, near_dedup

WORDS = [a + b + c for a in "kstrm" for b in "aeiou" for c in ("n", "r", "l", "nd")]


def prose(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def grams(text, k=5):
    w = text.lower().replace(".", " ").replace(",", " ").split()
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def jaccard_p(a, b):
    """Probability Jaccard by its definition."""
    wt = lambda c: {x: 1 + np.log(n) for x, n in c.items()}
    x, y = wt(a), wt(b)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def classes(rows):
    ids = {}
    for i, t in rows:
        ids.setdefault(t or "", []).append(i)
    texts = list(ids)
    root = {t: t for t in texts}
    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    g = {t: grams(t) for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if g[a] and g[b] and jaccard_p(g[a], g[b]) >= 0.8:
                root[find(a)] = find(b)
    groups = {}
    for t in texts:
        groups.setdefault(find(t), []).extend(ids[t])
    least = lambda l: min((x for x in l if x is not None), default=None)
    return {t: least(groups[find(t)]) for t in texts}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    rows, n = [], 0
    common_line = prose(rng, 9)
    for _ in range(25):
        base = prose(rng, rng.choice([3, 6, 30, 80, 120])) + (common_line if rng.random() < 0.5 else [])
        for _ in range(rng.randrange(1, 5)):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
            rows.append((n, " ".join(words)))
            n += 1
    base = prose(rng, 150)
    for _ in range(60):  # one large group of near copies, some of them far from most
        words = list(base)
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(150)] = rng.choice(WORDS) + "y"
        rows.append((n, " ".join(words)))
        n += 1
    rows += [(n + i, rows[3][1]) for i in range(6)] + [(n + 10, ("again and again " * 200)), (n + 11, "again and again " * 190 + "once more")]
    rows += [(n + 20, None), (n + 21, ""), (n + 22, "!!! ..."), (None, rows[3][1]), (None, "only this one has no id at all"), (5, rows[5][1]), (n + 30, " ".join(prose(rng, 30_000)))]
    return rows


def test_estimate_and_exact_similarity():
    rng = random.Random(2)
    a = prose(rng, 300) + prose(rng, 5) * 4
    b = list(a)
    for i in range(20, 300, 40):
        b[i] = "zzz"
    texts = [" ".join(a), " ".join(b)]
    owner, element, count = near_dedup.shingles([t.encode() for t in texts])
    sign = near_dedup.signatures(2, owner, element, near_dedup.weight(count), 4096)
    x, y = [(element[owner == i], near_dedup.weight(count[owner == i])) for i in (0, 1)]
    want = jaccard_p(grams(texts[0]), grams(texts[1]))
    assert near_dedup.similarity(*x, *y) == pytest.approx(want, abs=1e-9)
    assert (sign[0] == sign[1]).mean() == pytest.approx(want, abs=0.04)
    one = near_dedup.signatures(1, np.zeros(1, np.int64), np.array([7], np.uint64), np.ones(1), 160)
    assert (one == 7).all()


def test_classes_are_those_of_all_pairs(spark, corpus):
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in corpus], "doc_id long, text string, node string, key int")
    want = classes(corpus)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(corpus)
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, want[t or ""]) for i, t in corpus)
    kept = near_dedup.representatives(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter(set(want.values()))
    assert set(kept[0].asDict()) == {"doc_id", "text", "node", "key"}
    assert near_dedup.near_duplicates(docs.limit(0)).count() == near_dedup.representatives(docs.limit(0)).count() == 0


def test_buckets_cut_into_blocks_lose_no_link(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t in corpus], "doc_id long, text string")
    want = classes(corpus)
    got = near_dedup.near_duplicates(docs, block_elements=1_000).collect()  # blocks of about seven texts
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, want[t or ""]) for i, t in corpus)


@pytest.mark.parametrize("parts", [1, 2])
def test_a_meeting_joins_what_all_pairs_join(parts):
    rng = random.Random(parts)
    base, texts = prose(rng, 60) + prose(rng, 4) * 3, []
    for _ in range(80):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(WORDS) + "y"
        texts.append(words + words[-8:] * rng.randrange(0, 3))
    texts = [" ".join(t).encode() for t in texts]
    owner, element, count = near_dedup.shingles(texts)
    sets = [(element[owner == i], near_dedup.weight(count[owner == i])) for i in range(80)]
    part = np.arange(80) % parts
    root = np.where(np.arange(80) % 5 == 0, np.arange(80), 500 + part)  # some are one component already

    def groups(links):
        label = np.unique(root, return_inverse=True)[1]
        for i, j in links:
            label[label == label[i]] = label[j]
        return {frozenset(np.flatnonzero(label == x)) for x in set(label)}

    alike = {(i, j): near_dedup.similarity(*sets[i], *sets[j]) for i in range(80) for j in range(i) if parts == 1 or part[i] != part[j]}
    repeated = [np.repeat(element[owner == i], count[owner == i]) for i in range(80)]
    got = near_dedup.links_of_meeting(root.astype(str), part, repeated, 0.8)
    assert groups([(i, j) for i, j, _ in got]) == groups([p for p, s in alike.items() if s >= 0.8])
    assert 0 < len(got) < 80 and all(s == pytest.approx(alike[max(i, j), min(i, j)]) and s >= 0.8 for i, j, s in got)


def test_components_of_a_long_chain(spark):
    rows = [(bytes([0, i]), bytes([0, i + 1])) for i in range(60)] + [(b"x", b"y")]
    got = {bytes(r.node): bytes(r.root) for r in near_dedup.components(spark.createDataFrame(rows, "a binary, b binary")).collect()}
    assert len(got) == 63 and {v for k, v in got.items() if len(k) == 2} == {bytes([0, 0])} and got[b"y"] == b"x"


def test_components_join_each_link_in_one_round_only(spark, monkeypatch):
    rng = random.Random(6)
    pairs = {(min(p), max(p)) for g in range(3) for _ in range(600) if len(set(p := (g * 40 + rng.randrange(40), g * 40 + rng.randrange(40)))) == 2}
    pairs |= {(200 + i, 200 + (i * 7 + 1) % 50) for i in range(50)} | {(300, 5), (300, 45)}  # a node that only the second round joins to both
    edges, settle = [], near_dedup.settle

    def counted(df, label):
        table = settle(df, label)
        if label == "dedup-edges":
            edges.append(table.count())
        return table

    monkeypatch.setattr(near_dedup, "settle", counted)
    rows = [(bytes([a >> 8, a & 255]), bytes([b >> 8, b & 255])) for a, b in pairs if a != b]
    got = {(r.node[0] << 8) + r.node[1]: (r.root[0] << 8) + r.root[1] for r in near_dedup.components(spark.createDataFrame(rows, "a binary, b binary")).collect()}
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert len(edges) > 1 and edges[0] <= len(rows) and sum(edges[1:]) < edges[0] / 20 and edges[-1] == 0


def test_links_known_before_blocks_are_not_joined_again(spark, corpus, monkeypatch):
    given, components = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda links, *more: (given.append(links.count()), components(links, *more))[1])
    docs = spark.createDataFrame([(i, t) for i, t in corpus], "doc_id long, text string")
    want = classes(corpus)
    got = near_dedup.near_duplicates(docs, bands=8, block_elements=1_000).collect()  # few bands leave links to the blocks
    assert len(got) == len(corpus) and all(r.class_id is None or r.class_id >= want[dict(corpus).get(r.doc_id) or ""] for r in got if r.doc_id)
    assert len(given) == 2 and 0 < given[1] < given[0] / 4


def brute_leaks(docs, items):
    found = {}
    for d, t in docs:
        w = (t or "").lower().replace(".", " ").replace(",", " ").split()
        for item, it in items:
            v = (it or "").lower().replace(".", " ").replace(",", " ").split()
            if not v or not w:
                continue
            want = grams(" ".join(v))
            if len(v) < 5:
                if w == v:
                    found[d, item] = 1.0
                continue
            for s in range(max(1, len(w) - len(v) + 1)):
                have = grams(" ".join(w[s : s + len(v)]))
                sim = sum((have & want).values()) / sum((have | want).values())
                if sim >= 0.8:
                    found[d, item] = max(found.get((d, item), 0), sim)
    return found


def test_leaks_are_those_of_all_windows(spark):
    rng = random.Random(4)
    items = [(i, " ".join(prose(rng, rng.choice([8, 20, 47, 60, 90])))) for i in range(15)] + [(20, "two words"), (21, None), (22, "")]
    docs = []
    for d in range(40):
        words = prose(rng, rng.choice([10, 60, 200]))
        for _ in range(rng.randrange(3)):
            passage = items[rng.randrange(15)][1].split()
            change = rng.random()
            if change < 0.3:
                passage[rng.choice([0, len(passage) - 1, len(passage) // 2])] = "edited"
            elif change < 0.45:
                passage.insert(rng.randrange(len(passage)), "more")
            elif change < 0.6:
                passage = passage[: len(passage) // 2]
            at = rng.randrange(len(words))
            words[at:at] = passage
        docs.append((d, ". ".join(words).upper() if d % 3 == 0 else " ".join(words)))
    docs += [(50, None), (51, ""), (52, "two words"), (53, "here are two words too"), (54, items[0][1]), (54, items[0][1]), (None, items[1][1]), (55, (items[2][1] + " ") * 40)]
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in docs], "doc_id long, text string, start int, item_id string")
    bench = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, words int")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_leaks(df, bench).collect()}
    assert got == pytest.approx(brute_leaks(docs, items))
    leaking = {d for d, _ in got}
    assert {r.doc_id for r in decontaminate.without_leaks(df, bench).collect()} == {d for d, _ in docs} - leaking
    assert decontaminate.find_leaks(df.limit(0), bench).count() == decontaminate.find_leaks(df, bench.limit(0)).count() == 0


def test_blocks_guarantee_the_radius(spark):
    rng = random.Random(6)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = rng.getrandbits(64)
    prints = []
    for i in range(120):
        x = base
        for b in rng.sample(range(64), i % 20):
            x ^= 1 << b
        prints.append((i, i % 20, signed(x)))
    windows = spark.createDataFrame([(bytes([i]), 0, 9, x) for i, _, x in prints], "key binary, start int, n_words int, fingerprint long")
    items = spark.createDataFrame([(1, 9, signed(base)), (2, 8, signed(base))], "item long, n_words int, fingerprint long")
    got = {r.key[0]: r.distance for r in decontaminate.within_radius(windows, items, 13).collect()}
    assert got == {i: d for i, d, _ in prints if d <= 13}


def test_leaks_of_the_table(spark, sf):
    docs, bench = common.table(spark, sf, "documents"), common.table(spark, sf, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    squeeze = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) + " "
    items = [(r.item_id, squeeze(r.text)) for r in bench.collect()]
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in squeeze(r.text)}
    assert exact and exact <= got


def leaks(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_leaks_cut_at_an_end_of_the_document(spark):
    rng = random.Random(8)
    item, fore = prose(rng, 59), prose(rng, 40)
    docs = [fore + item[:-1], fore + item[:-4], item[:29] + item[30:], item[:-1], item[1:], item[2:] + fore, item[:-1] + item[:3], item[5:-8]]
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    got = leaks(spark, docs, [(1, " ".join(item))])
    want = brute_leaks(docs, [(1, " ".join(item))])
    assert {k: r.similarity for k, r in got.items()} == pytest.approx(want) and {d for d, _ in want} == set(range(7))
    assert (got[0, 1].start, got[0, 1].n_words) == (39, 59) and (got[3, 1].start, got[3, 1].n_words) == (0, 58)


def test_leaks_of_reordered_items(spark):
    rng = random.Random(9)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([59, 80, 40])]
    docs = []
    for d in range(12):
        words = items[d % 3][1].split()
        at = rng.randrange(10, len(words) - 10)
        docs.append((d, " ".join(prose(rng, 40) + words[at:] + words[:at] + prose(rng, 40))))
    docs.append((20, items[0][1] + " " + " ".join(prose(rng, 3)) + " " + items[0][1]))
    got, want = leaks(spark, docs, items), brute_leaks(docs, items)
    assert {k: r.similarity for k, r in got.items()} == pytest.approx(want) and len(want) == 13
    assert got[20, 0].start == 0


def test_leaks_of_far_fingerprints(spark):
    rng = random.Random(11)
    item = prose(rng, 100)
    docs = [(d, " ".join(prose(rng, 40) + item[10:] + prose(rng, 30))) for d in range(200)]
    got = leaks(spark, docs, [(1, " ".join(item))])
    assert len(got) == 200 and all(r.similarity == pytest.approx(86 / 106) for r in got.values())
    assert max(r.distance for r in got.values()) > 13
