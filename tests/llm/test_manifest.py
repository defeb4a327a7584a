import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from flowloom.llm import merkle_manifest as mm


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root and, for each leaf, its siblings level by level as (before, after)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            run, slot = divmod(at[i], 16)
            members = nodes[run * 16 : run * 16 + 16]
            p.append(("".join(members[:slot]), "".join(members[slot + 1 :])))
            at[i] = run
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[s] = tree([leaf(r) for r in groups[s]])
    root, over = tree([tops[s][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for r, path in zip(groups[s], tops[s][1]):
            path = path + over[n]
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            back = leaf((*r[:4], low)) if hit else leaf(r)
            for before, after in path:
                back = sha(before + back + after)
            out.append((r[0], leaf(r), tops[s][0], root, sha("".join(a + b for a, b in path)), back, back == root))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, number int")
    key = lambda r: (r[0] is not None, *r)
    order = lambda rs: sorted((tuple(r) for r in rs), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    assert order(mm.tampering_check(df).collect()) == order(brute(rows))


def test_manifest_is_brute_force(spark):
    rng = random.Random(1)
    ids = rng.sample(range(-300, 3000), 600) + [2**40 + i * 7 for i in range(20)] + [2**62, -(2**62), -(2**63), 2**63 - 1, 63, 64, 127, 65535, 65536]
    rows = [(i, rng.choice(["a", "b", "B", "é", "zz"]) if n > 300 else "hot", rng.choice(["en", None]), rng.choice([None, 3]), rng.choice([None, "", "Some Text", "lower", "É A"]))
            for n, i in enumerate(dict.fromkeys(ids))]
    rows += [(5, None, None, None, None), (7, "", "en", 1, "One"), (None, "a", None, 2, "N"), (None, "a", None, 3, "M"), (None, None, None, None, None)]
    rows += [(11, "again", "en", n % 3, f"T{n % 5}") for n in range(70)] + [(12, "again", "en", 1, "x")]  # one id in many rows, equal ones too
    check(spark, rows)


def test_small_manifests(spark):
    check(spark, [(1, "a", "en", 1, "T")])
    check(spark, [(i, None, "en", 1, "T") for i in range(17)])
    check(spark, [(i, f"s{i}", "en", 1, "T") for i in range(18)])
    check(spark, [(i % 3, "a", "en", 1, "T") for i in range(300)])
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert mm.tampering_check(df).count() == 0


def test_copies_beyond_one_sequence(spark):
    leaves = spark.createDataFrame([(0, 5, "x", 10, 3)], "number int, id long, leaf string, n long, pos long")
    got = mm._each_copy(leaves, at_once=4).select("pos").collect()
    assert sorted(r.pos for r in got) == list(range(3, 13))


def test_tampering_is_found_and_rows_do_not_meet_the_root_of_others(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = mm.manifest(docs)
    assert found.filter(mm.folded(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
    assert found.filter(mm.folded(F.col("subroot"), F.col("path")) == F.col("root")).isEmpty()
    checked = mm.tampering_check(docs)
    changed = docs.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").rlike("[A-Z]")).count()
    assert changed and checked.filter(~F.col("verified")).count() == changed
