"""Exact byte-pair encoding by backtracking over longest matches, and table decoding.

A word of the splitting pattern is encoded left to right: an Aho-Corasick automaton
over all tokens gives the longest token that starts at each byte; it is taken if it
is compatible with the token before it, else the next shorter token that is a prefix
of it is tried, and where none is left the token before is taken back. Places that
were given up once are never entered again, so the work is linear in the word.

Two neighbours are compatible if byte-pair merging of their joined bytes leaves the
border between them alone. The answer follows from undoing merges, latest first, at
the border; it is kept in a table by pair. A sequence whose neighbours are all
compatible is the one that merging gives.

Decoding looks up each id in one byte string by an offset table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import tidy
from flowloom.llm.token_counts import PATTERN, STABLE, byte_alphabet

#: Texts are split and hashed in slices of about so many characters, cut at stable places.
SLICE_CHARS = 1_000_000
#: Entries of the tables of words and pairs that a worker keeps; a full one starts anew.
KEPT = 400_000
#: The splitting pattern for texts of Latin-1 characters only: the same classes, spelled out.
_L, _N, _S = r"A-Za-zªµºÀ-ÖØ-öø-ÿ", r"0-9²³¹¼-¾", r"\t-\r \x85\xa0"
LATIN_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


class BacktrackingBPE:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_byte = byte_alphabet()
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for word, i in vocab.items():
            self.bytes_of[i] = bytes(as_byte[c] for c in word)
        self.id_of = {b: i for i, b in enumerate(self.bytes_of) if b}
        for word, i in self.special.items():
            self.bytes_of[i] = word.encode()
        #: The merge that makes a token: its rank (-1 for single bytes) and its two parts.
        self.rank, self.parts, self.merge = [-1] * size, [(i, i) for i in range(size)], {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            if self.rank[made] < 0:
                self.rank[made], self.parts[made] = rank, (vocab[left], vocab[right])
            self.merge[vocab[left] << 32 | vocab[right]] = rank
        self.length = [len(b) for b in self.bytes_of]
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton()
        for b, i in self.id_of.items():
            self.automaton.add_word(b.decode("latin-1"), i)
            self.shorter[i] = next((self.id_of[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.id_of), -1)
        self.automaton.make_automaton()
        self.kept = KEPT
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[tuple[int, ...], str]] = {}
        self.split, self.split_latin = regex.compile(PATTERN).findall, re.compile(LATIN_PATTERN).findall
        self.stable = regex.compile(STABLE)
        self.on_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        #: Decoding: all tokens in one byte string, and where each begins.
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two neighbours alone."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.kept:
                self.pairs.clear()
            known = self.pairs[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        before = 1 << 60  # a merge across the border of a lower rank would have come first
        while True:
            if self.merge.get(left << 32 | right, before) < before:
                return False
            if self.rank[left] > self.rank[right]:
                before, left = self.rank[left], self.parts[left][1]
            elif self.rank[right] >= 0:  # of equal merges the left one comes first
                before, right = self.rank[right] + 1, self.parts[right][0]
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of one word of the splitting pattern."""
        if (whole := self.id_of.get(word)) is not None:
            return [whole]
        n, longest = len(word), [-1] * len(word)
        for end, token in self.automaton.iter(word.decode("latin-1")):
            longest[end + 1 - self.length[token]] = token  # ends come in order: the last is the longest
        dead, taken, at, token = bytearray(n + 1), [], 0, longest[0]
        while at < n:
            end = at + self.length[token]
            if not dead[end] and (not taken or self.compatible(taken[-1], token)):
                taken.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                dead[at] = 1
                token = taken.pop()
                at -= self.length[token]
        return taken

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        if len(self.words) >= self.kept:
            self.words.clear()
        ids = tuple(self.encode_word(word.encode()))
        entry = ids, ",".join(map(str, ids))
        if len(word) <= 64:
            self.words[word] = entry
        return entry

    def slices(self, text: str) -> Iterator[str]:
        """The text in stretches that end at stable places or around special strings."""
        for part in self.on_special.split(text) if self.on_special else [text]:
            start = 0
            while len(part) - start > SLICE_CHARS and (m := self.stable.search(part, start + SLICE_CHARS, len(part) - 1)):
                yield part[start : m.start()]
                start = m.start()
            if start < len(part):
                yield part[start:] if start else part

    def encode_slices(self, text: str) -> Iterator[tuple[list[tuple[int, ...]], str]]:
        """For each stretch: the ids of its words, and all its ids as decimals joined by commas."""
        for part in self.slices(text):
            if part in self.special:
                yield [(self.special[part],)], str(self.special[part])
                continue
            words = (self.split_latin if _is_latin(part) else self.split)(part)
            known = self.words
            entries = [known.get(w) or self._word(w) for w in words]
            yield [e[0] for e in entries], ",".join([e[1] for e in entries])

    def encode(self, text: str) -> list[int]:
        return [i for ids, _ in self.encode_slices(text) for i in chain.from_iterable(ids)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids, by the offset table."""
        if not len(ids):
            return b""
        starts, sizes = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()

    def digest(self, text: str | None, keep: bool = False) -> tuple[int, str, str, np.ndarray]:
        """Tokens, hash of the ids and hash of the decoded text, one stretch at a time; with `keep` also the ids."""
        ids_hash, text_hash, total, kept = hashlib.sha256(), hashlib.sha256(), 0, [np.zeros(0, np.int32)]
        for words, joined in self.encode_slices(text or ""):
            ids = np.fromiter(chain.from_iterable(words), np.int64)
            ids_hash.update(("," + joined if total else joined).encode())
            total += len(ids)
            if keep:
                kept.append(ids.astype(np.int32))
            # stretches of a text end between characters, so each decodes to valid UTF-8
            text_hash.update(self.decode_bytes(ids).decode("utf-8", "replace").encode())
        return total, ids_hash.hexdigest(), text_hash.hexdigest(), np.concatenate(kept)


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def coder(path: str) -> BacktrackingBPE:
    return BacktrackingBPE(path)


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 keep_ids: bool = False, keep_text: bool = False, kept_words: int = KEPT, forget: bool = False) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, ids_sha256, decoded_sha256, with
    `keep_ids` also token_ids (array of int) and with `keep_text` decoded (string).

    Null and empty texts have no tokens and the hashes of the empty string. Repeated
    rows and ids are kept as they are; other columns are not read. There is no shuffle.
    A worker remembers the tokens of up to `kept_words` words, which costs memory and no results; with `forget` only to the end of a task,
    where it also returns unused memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(tokenizer_path)
        bpe.kept = kept_words
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            n, ids_hash, text_hash, ids = zip(*[bpe.digest(t, keep_ids or keep_text) for t in texts]) if texts else ((), (), (), ())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            if keep_ids:
                offsets = np.append(0, np.cumsum(n)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))))
            if keep_text:
                columns.append(pa.array([bpe.decode_bytes(i).decode("utf-8", "replace") for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)
        if forget:  # the worker goes on to other stages
            bpe.words.clear()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [("id", rows.schema["id"].dataType.simpleString()), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    fields += [("token_ids", "array<int>")] * keep_ids + [("decoded", "string")] * keep_text
    names = [n for n, _ in fields]
    return rows.mapInArrow(tidy(run) if forget else run, ", ".join(f"{n} {t}" for n, t in fields)).withColumnRenamed("id", id_col)
