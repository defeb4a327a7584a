"""Token counts of whole texts by overlap resynchronisation.

A text of up to `piece_chars` characters is encoded at once. A longer one is cut
into pieces that start every `piece_chars` characters and run `overlap_chars` into
the next piece. Each piece is encoded on its own with the byte offsets of its
tokens; two neighbours are spliced at the first place of their overlap that

* is proven stable: a letter stands before it, and after it a blank with a letter or
  a sign other than `|`. No alternative of the splitting pattern and no special
  string runs across such a place, so what follows is the same whatever came before;
* is a token boundary in both encodings.

If an overlap has no such place, it is doubled until it has one or the piece
reaches the end of the text. The sum over spliced parts is the count of the whole
text, and memory is bounded by the pieces, not by the text.

The byte-pair ranks are those of the given tokenizers file, run by tiktoken, which
gives the same ids in less time; widened pieces use the tokenizers library itself,
which has no limit on the length of one word.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPECIAL = "<|endoftext|>"
#: The splitting pattern of the byte-level pre-tokenizer (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Behind a letter, before a blank and a letter or before a sign.
STABLE = r"(?<=\p{L})(?= \p{L}|[^\s\p{L}\p{N}|])"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable bytes stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Callable, Callable, list[int]]:
    """Fast and unlimited encoders of a tokenizers file, and the byte length of each id."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    as_byte = byte_alphabet()
    ranks = {bytes(as_byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    fast = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow = Tokenizer.from_file(path)
    slow.no_truncation()
    slow.no_padding()
    lengths = [0] * (max([*ranks.values(), *special.values()]) + 1)
    for word, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
        lengths[i] = len(word)

    def quick(text: str) -> list[int]:
        if any(s in text for s in special):
            return fast.encode(text, allowed_special="all")
        return fast.encode_ordinary(text)

    def unlimited(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids

    return quick, unlimited, lengths


class _Piece:
    """One encoded stretch of a text, with the byte offsets where its tokens end."""

    def __init__(self, text: str, start: int, end: int, encode: Callable, lengths: list[int]):
        self.text, self.start, self.end = text[start:end], start, end
        at, self.index = 0, {0: 0}
        for k, token in enumerate(encode(self.text), 1):
            at += lengths[token]
            self.index[at] = k
        self.tokens = len(self.index) - 1

    def tokens_before(self, place: int) -> int | None:
        """Tokens that end at or before a place of the text; None where no token ends there."""
        return self.index.get(len(self.text[: place - self.start].encode()))


def count_long(text: str, path: str, piece_chars: int, overlap_chars: int) -> int:
    """Tokens of one text, piece by piece."""
    import regex

    quick, unlimited, lengths = encoder(path)
    stable = regex.compile(STABLE)
    n, total = len(text), 0
    left, skipped, place = _Piece(text, 0, min(n, piece_chars + overlap_chars), quick, lengths), 0, 0
    while left.end < n:
        seam, overlap, splice = max(left.start + piece_chars, place), overlap_chars, None
        while splice is None and left.end < n:
            right = _Piece(text, seam, min(n, seam + max(piece_chars, overlap) + overlap_chars),
                           quick if overlap == overlap_chars else unlimited, lengths)
            for m in stable.finditer(text, seam, min(left.end, right.end) - 1):
                a, b = left.tokens_before(m.start()), right.tokens_before(m.start())
                if a is not None and b is not None:
                    splice, place = (a, b), m.start()
                    break
            else:
                overlap *= 2
                left = _Piece(text, left.start, min(n, seam + overlap), unlimited, lengths)
        if splice is None:
            break
        total += splice[0] - skipped
        left, skipped = right, splice[1]
    return total + left.tokens - skipped


def count_text(text: str | None, path: str, piece_chars: int, overlap_chars: int) -> int:
    if not text:
        return 0
    if len(text) <= piece_chars + overlap_chars:
        return len(encoder(path)[0](text))
    return count_long(text, path, piece_chars, overlap_chars)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, piece_chars: int = 32_768, overlap_chars: int = 512) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens. Rows are counted one by one, so
    repeated rows and repeated or null ids come back as often as they came in. Other
    columns are not read. There is no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [count_text(t.as_py(), tokenizer_path, piece_chars, overlap_chars) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_col)
