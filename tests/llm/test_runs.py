import hashlib
import random
import zlib

import numpy as np
import pytest

from flowloom.llm import periodic_runs


def brute(words, min_length=24, times=3):
    """Every stretch whose words equal those q before, in full, for each q; those of a smaller period inside are dropped."""
    found = []
    for q in range(1, len(words) // times + 1):
        lo = 0
        while lo + q < len(words):
            hi = lo
            while hi + q < len(words) and words[hi] == words[hi + q]:
                hi += 1
            length = hi - lo + q
            if hi > lo and length >= max(min_length, times * q):
                if not any(s <= lo and s + n >= lo + length for s, n, p in found if p < q):
                    found.append((lo, length, q))
            lo = hi + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(3)
    for _ in range(400):
        kind, words = rng.randrange(5), []
        for _ in range(rng.randrange(1, 5)):
            base = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, rng.choice([4, 9, 20, 70])))]
            if kind == 0:
                words += base * rng.randrange(1, 9)
            elif kind == 1:
                inner = base * rng.randrange(1, 5) + [rng.randrange(3)]
                words += inner * rng.randrange(2, 6)
            elif kind == 2:
                words += [rng.randrange(2) for _ in range(rng.randrange(60))]
            else:
                words += base * rng.randrange(1, 5) + base[: rng.randrange(len(base))] + [99] * rng.randrange(3)
        yield words
    a, b = [0], [0, 1]
    for _ in range(11):
        a, b = b, b + a
    yield b[:400]  # Fibonacci words hold many runs of other periods at one place
    yield [bin(i).count("1") % 2 for i in range(300)]  # and this one no cube at all


@pytest.mark.parametrize("step", [1, 7, 64, 100_000])
def test_runs_are_those_of_brute_force_however_words_arrive(step):
    for n, words in enumerate(sequences()):
        if step == 1 and n % 4:
            continue
        text = [str(w).encode() for w in words]
        assert periodic_runs.runs_of(text, step=step) == brute(words), words


def test_runs_after_every_word():
    words = [1, 2, 3] * 12 + [9] + [5] * 30
    catchers = periodic_runs.Catchers()
    for n, w in enumerate(words, 1):
        catchers.append(np.array([w], np.int64))
        assert catchers.runs() == brute(words[:n])


def test_long_loops_are_quick():
    words = [b"a"] * 300_000 + [b"%d" % (i % 1000) for i in range(300_000)]
    assert [r for r in periodic_runs.runs_of(words)] == [(0, 300_000, 1), (300_000, 300_000, 1000)]


def expected(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_columns_are_those_of_brute_force(spark):
    rng = random.Random(4)
    looped = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(200)))) for i in looped]
    rows += [(1000, "a b " * 20 + "c"), (1001, "a b c " * 30), (1002, "x\x1fy\x85 z\t\n\x0b\x0c\r" * 12), (1003, None), (1004, ""), (1005, " \t "), (None, "q " * 30),
             (1000, "a b " * 20 + "c"), (1006, "a " * 24 + "b " * 24 + "a " * 23), (looped[0], None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, runs string")
    got = [tuple(r) for r in periodic_runs.digests(periodic_runs.find_runs(df, edit=periodic_runs.looped)).collect()]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(got, key=key) == sorted((expected(i, t) for i, t in rows), key=key)
    assert periodic_runs.find_runs(df.limit(0)).count() == 0


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {tuple(r) for r in periodic_runs.digests(periodic_runs.find_runs(docs, edit=periodic_runs.looped)).collect()}
    short = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 4000]
    assert len(short) > 100 and {expected(*r) for r in short} <= got
