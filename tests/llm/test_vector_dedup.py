import numpy as np
import pytest

from flowloom.llm import vector_dedup as vd


def brute(rows, threshold=0.9):
    """(id, n_links, component, kept) of each row, all pairs compared; links are by row, components by vector."""
    ok = [i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x for x in v) for i, v in rows]
    linked = [[] for _ in rows]
    unit = [np.array(v, float) / np.abs(v).max() if o else None for (_, v), o in zip(rows, ok)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and (unit[i] @ unit[j] >= threshold or rows[i][1] == rows[j][1]):
                linked[i].append(j)
                linked[j].append(i)
    part = list(range(len(rows)))
    for start in range(len(rows)):
        stack = [start]
        while stack:
            n = stack.pop()
            for m in linked[n]:
                if part[m] > part[start]:
                    part[m] = part[start]
                    stack.append(m)
    low = {}
    for (i, _), p in zip(rows, part):
        low[p] = min(x for x in (low.get(p), i) if x is not None) if i is not None or p in low else None
    return [(i, len(linked[n]), None if i is None else low[part[n]], None if i is None else i == low[part[n]]) for n, (i, _) in enumerate(rows)]


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))


def clustered(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dim))
    return [(i, (centres[i % len(centres)] + spread * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, node long, code string"


def test_links_are_those_of_brute_force(spark):
    rows = clustered(1, 400, 32, 0.05)
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000 + i, (np.array(rows[9][1]) * (1 + i)).astype(np.float32).tolist()) for i in range(5)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 32), (3003, [float("nan")] * 32), (3004, [None] * 32), (3005, [float("inf")] * 32), (None, rows[0][1]), (None, None)]
    rows += [(4000, [1.0, 2.0]), (4001, [2.0, 4.0]), (4002, [1.0]), (4003, [3.0]), (4004, [-1.0]), (3, rows[3][1]), (5000, [1e-30] * 32), (5001, [1e30] * 32)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    for kw in ({}, {"bucket_rows": 16}, {"dense": 0}):
        assert order(vd.near_duplicates(df, **kw).collect()) == order(brute(rows))
    assert vd.near_duplicates(df.limit(0)).count() == 0


def test_doubles_and_missed_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(10 * n + i, (base * (1 + 0.01 * rng.normal(size=n))).tolist()) for n in range(2, 12) for base in [rng.normal(size=n)] for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert order(vd.near_duplicates(df, sample_rows=5).collect()) == order(brute(rows))


def test_a_group_of_most_rows_is_one_component(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (np.ones(16) + 0.1 * rng.normal(size=16)).tolist()) for i in range(500)] + [(1000 + i, rng.normal(size=16).tolist()) for i in range(200)]
    got = vd.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = {r[0]: r for r in brute(rows)}
    assert sum(r.n_links for r in got) >= 0.99 * sum(r[1] for r in want.values())
    assert sum(want[r.vec_id][2] == r.component_id for r in got) >= 690


@pytest.mark.parametrize("dim", [64, 128])
def test_recall_near_the_threshold(spark, dim):
    """Pairs of every cosine from 0.9 up, and one group of 300 alike: at least 0.9 of all links, none that is no link."""
    rng = np.random.default_rng(dim)
    rows = []
    for n in range(600):
        v, w = rng.normal(size=dim), rng.normal(size=dim)
        v /= np.linalg.norm(v)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        c = 0.9 + 0.1 * rng.random()
        rows += [(2 * n, v.tolist()), (2 * n + 1, (c * v + np.sqrt(1 - c * c) * w).tolist())]
    rows += [(10_000 + i, (1 + 0.2 * rng.normal(size=dim)).tolist()) for i in range(300)]
    want = {r[0]: r[1] for r in brute(rows)}
    got = {r.vec_id: r.n_links for r in vd.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[i] <= want[i] for i in want)
    pairs = sum(got[i] for i in range(1200)) / sum(want[i] for i in range(1200))
    group = sum(got[i] for i in want if i >= 10_000) / sum(want[i] for i in want if i >= 10_000)
    print("recall of pairs", pairs, "and of the group", group)
    assert min(pairs, group) >= (0.95 if dim == 64 else 0.9)
