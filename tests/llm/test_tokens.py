import hashlib

import pytest

from flowloom.llm import bpe, common, token_counts

PATH = common.tokenizer_file()
ODD = [
    "", " ", "a" * 5000, " " * 3000 + "b", "<|endoftext|>" * 30 + "abc " * 100, "abc<|endof" * 30, "\n\n \t" * 300 + "x's don't I'll " * 90,
    "日本語" * 300, "é" * 900 + " word" * 40, "''''s'll" * 100, "x  y   " * 200, "٣٤ ½x\u2028y\u00a0z\u0085 \u1680", "naïve café 123 ²³ _under_ \x1c\x1d",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_every_code_point_is_split_like_the_library(library):
    points = [c for c in range(0x3400) if not 0xD800 <= c < 0xE000] + list(range(0xF900, 0x11000)) + list(range(0x1D400, 0x1D800)) + list(range(0x1F300, 0x1F700))
    texts = [f"x{chr(c)} {chr(c)}1{chr(c)}!{chr(c)}  {chr(c)}{chr(c)} y" for c in points]
    quick, coder = token_counts.encoder(PATH)[0], bpe.coder(PATH)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert quick(text) == want.ids and coder.encode(text) == want.ids


@pytest.mark.parametrize(("piece", "overlap"), [(40, 4), (100, 10), (1000, 64)])
def test_spliced_counts_are_those_of_the_whole(library, piece, overlap):
    for text in ODD:
        assert token_counts.count_text(text, PATH, piece, overlap) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_token_of_the_vocabulary_encodes_to_itself():
    coder = bpe.coder(PATH)
    assert all(coder.encode_word(b) == [i] for b, i in coder.id_of.items())


def test_backtracking_is_merging():
    coder = bpe.coder(PATH)

    def merged(word: bytes) -> list[int]:
        ids = [coder.id_of[bytes([b])] for b in word]
        while True:
            ranked = [(coder.merge[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in coder.merge]
            if not ranked:
                return ids
            _, i = min(ranked)
            ids[i : i + 2] = [coder.id_of[coder.bytes_of[ids[i]] + coder.bytes_of[ids[i + 1]]]]

    for word in [b"aaaaaaa", b" thanedble", "ciónmente".encode(), b"!!!???!!!", bytes(range(200, 240)), b"ThThThaahhahaha", b"zzzzzzzzzzzzzzzzz"]:
        assert coder.encode_word(word) == merged(word)


def test_queries_on_documents_and_edge_cases(spark, sf, library):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(3, None), (3, None), (None, "null id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, n_tokens string, id int")
    counted = token_counts.count_tokens(docs, PATH, piece_chars=100, overlap_chars=8).collect()
    coded = bpe.encode_texts(docs, PATH, keep_ids=True, keep_text=True).collect()
    assert len(counted) == len(coded) == len(texts)
    for (i, t), a, b in zip(texts, counted, coded):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (a.doc_id, a.n_bytes, a.n_tokens, a.over_limit) == (i, len((t or "").encode()), len(ids), len(ids) > 1024)
        assert (b.doc_id, b.n_tokens, b.token_ids, b.decoded) == (i, len(ids), ids, t or "")
        assert b.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert b.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == bpe.encode_texts(docs.limit(0), PATH).count() == 0
    whole = {r.doc_id: r.text for r in common.table(spark, sf, "documents").collect()}
    for r in token_counts.count_tokens(common.table(spark, sf, "documents"), PATH, piece_chars=500, overlap_chars=20).collect():
        assert r.n_tokens == len(library.encode(whole[r.doc_id], add_special_tokens=False).ids)


def test_long_texts_are_sliced_without_a_trace(monkeypatch):
    coder = bpe.coder(PATH)
    text = " ".join(["word", "naïve's", "x1!"] * 400) + "<|endoftext|> tail"
    want = coder.digest(text)[:3]
    monkeypatch.setattr(bpe, "SLICE_CHARS", 50)
    assert coder.digest(text)[:3] == want
