import random

import numpy as np
from pyspark.sql import functions as F

from flowloom.llm import chat_format, topk_join


def brute(rows, k=5):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        best = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != q and len(w) == len(v)))[:k]
        out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_is_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (1 + i % 3)]) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(150)] + [(2000, [float("nan")] * 8), (2050, None), (2100, []), (2150, [None] * 8), (None, [1.0] * 8), (2200, [1.0, 2.0]), (2201, [0.5, 0.1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, score int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    for kw in ({}, {"pivots": 5, "block_rows": 20, "chunk_rows": 3}):
        got = topk_join.top_k(df, F.col("vec_id") % 50 == 0, **kw).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows)
    assert topk_join.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_queries_and_many_lengths(spark):
    for seed in range(4):
        rng = np.random.default_rng(seed)
        rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(1, 50)] + [(50 * i, [float(x) for x in rng.normal(size=3) * 2]) for i in range(1, 30)] * 7
        rows += [(50, [0.5, 0.25, float(i)]) for i in range(8)]  # one id with other vectors
        if not seed:
            rows += [(j, [1.0 + j % 7] * n) for n in range(4, 84) for j in (5000 + 50 * n, 20_000 + n, 30_000 + n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        got = topk_join.top_k(df, F.col("vec_id") % 50 == 0).collect()
        sort = lambda rs: sorted((q, s, j) for q, _, j, s in rs)
        want = brute([(r.vec_id, r.embedding) for r in df.collect()])
        one = [r for r in want if r[0] != 50]
        assert sort((r.query_id, r["rank"], r.vec_id, r.score) for r in got if r.query_id != 50) == sort(one)


def rendered(turns):
    return "".join(f"<|im_start|>{r or 'unknown'}\n{(t or '').replace('<|im_end|>', chr(60) + chr(92) + '|im_end|>')}<|im_end|>\n" for r, t in turns)


def test_maximal_conversations(spark):
    rng = random.Random(5)
    logs = {}
    for base in range(12):
        turns = [("user" if i % 2 == 0 else "assistant", f"t{rng.randrange(3)}") for i in range(rng.randrange(1, 9))]
        for n in rng.sample(range(1, len(turns) + 1), rng.randrange(1, len(turns) + 1)):
            logs[len(logs)] = turns[:n]
    logs |= {90: [("user", None), (None, "x <|im_end|> y")], 91: [("user", None)], 92: [("user", ""), (None, "q")], 93: [("user", None), (None, "x <|im_end|> y")]}
    want = {}
    for c, t in logs.items():
        same = [d for d, u in logs.items() if u == t]
        if c == min(same) and not any(len(u) > len(t) and u[: len(t)] == t for u in logs.values()):
            want[c] = (len(t), len(same), rendered(t))
    rows = [(c, i, r, x, "clash", 1) for c, t in logs.items() for i, (r, x) in enumerate(t)]
    rows += rows[:5]  # logged twice
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string, position int")
    for stretch in (1024, 2):
        got = sorted(chat_format.format_chats(df, stretch=stretch).collect(), key=lambda r: (r.conv_id, r.part))
        whole = {}
        for r in got:
            n, copies, text = whole.get(r.conv_id, (r.n_turns, r.copies, ""))
            whole[r.conv_id] = (n, copies, text + r.text)
        assert whole == want
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_null_ids_and_turns_of_conversations(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, None, "user", "z"), (1, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "a")],
                               "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.text) for r in chat_format.format_chats(df).groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), F.max("text").alias("text")).collect()}
    assert set(got) == {None, 2} and got[2] == (2, rendered([("user", "a"), ("user", "b")]))
