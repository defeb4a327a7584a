"""Periodic runs of words by online dyadic square catching.

Words arrive one after the other (`append` takes any number of them at a time). For every power of two
s from 8 up, each completed block of s words that starts at a multiple of s has a catcher: it waits for the block to
come again q words later, s <= q < 2s (for s = 8 also every smaller q). A stretch of
period q that is three periods and 24 words long holds such a block whole in the part that returns,
so no run escapes. A catch is a stretch of words equal to the words q before them; it is followed
to both sides, and from 2q words on (16 at least) it is a run. Catches of a run that is known
already, at multiples of its period, are passed over; the runs that remain are maximal and carry
their smallest period.

Blocks are compared by rolling hashes that double from level to level, every hash hit is
checked word by word, so hashes decide nothing.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 8  # words of the smallest blocks
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Catchers:
    """Runs of a sequence of whole numbers that grows by `append`."""

    def __init__(self, min_length: int = 24, times: int = 3) -> None:
        if min_length < 3 * LEAST or times < 3:
            raise ValueError("runs shorter than 24 words or three periods can escape the smallest blocks")
        self.min_length, self.times = min_length, times
        self.words = np.empty(0, np.int64)
        self.level: list[np.ndarray] = []  # hashes of the complete windows of each level
        self.waiting: list[int] = []  # the first block of each level whose windows are not all complete
        self.stretches: list[list[int]] = []  # [lo, hi, period]: words lo to hi equal the words a period on
        self.latest: dict[int, list[int]] = {}  # the last stretch of each period

    def append(self, more: np.ndarray) -> None:
        """New words: stretches that reached the end grow, then every level compares the blocks whose windows are complete."""
        old, self.words = len(self.words), np.concatenate([self.words, more])
        for s in self.latest.values():
            if s[1] + s[2] == old:
                s[1] = _grow(self.words, s[1], s[2])
        size, at = LEAST, 0
        while size * self.times <= len(self.words):
            if at == len(self.level):
                self.level.append(np.empty(0, np.uint64))
                self.waiting.append(0)
            known, whole = len(self.level[at]), len(self.words) - size + 1
            if at == 0:
                new = self._hashes(known, whole)
            else:
                below = self.level[at - 1]
                new = _join(below[known:whole], below[known + size // 2 : whole + size // 2], at)
            h = self.level[at] = np.concatenate([self.level[at], new])
            first, last = self.waiting[at], max(self.waiting[at], whole // size - 1)
            if last > first:
                block = h[first * size : last * size : size]
                k, q = np.nonzero(h[(first + 1) * size : (last + 1) * size].reshape(-1, size) == block[:, None])
                place, period = (k + first) * size, q + size
                if at == 0:
                    near = [h[first * size + d : last * size + d : size] == block for d in range(1, size)]
                    q, k = np.nonzero(near)
                    place, period = np.concatenate([(k + first) * size, place]), np.concatenate([q + 1, period])
                self._merge(place, period, size)
                self.waiting[at] = last
            size, at = size * 2, at + 1

    def _hashes(self, start: int, end: int) -> np.ndarray:
        h, width = self.words[start : end + LEAST - 1].astype(np.uint64) * _SPREAD, 1
        while width < LEAST:
            h, width = _join(h[:-width], h[width:], 20 + width), width * 2
        return h

    def _merge(self, place: np.ndarray, period: np.ndarray, size: int) -> None:
        """Catches of blocks of `size` words become stretches, those of a run that is known already are passed over."""
        if not len(place):
            return
        known = np.array([s for s in self.stretches if s[2] <= size and self._is_run(*s)], np.int64).reshape(-1, 3)
        if len(known):  # a stretch that has such a run's period too, for so long, is that run again
            inside = _covered(known[:, 0], known[:, 1] + known[:, 2], place, place + period + size)
            place, period = place[~inside], period[~inside]
        order = np.lexsort((place, period))
        for i, q in zip(place[order].tolist(), period[order].tolist()):
            seen = self.latest.get(q)
            if seen and seen[0] <= i < seen[1] or size > LEAST and self._in_run(i, i + q + size, size):
                continue
            if np.array_equal(self.words[i : i + size], self.words[i + q : i + q + size]):
                self.latest[q] = [_grow_back(self.words, i, q), _grow(self.words, i + size, q), q]
                self.stretches.append(self.latest[q])

    def _is_run(self, lo: int, hi: int, period: int) -> bool:
        return hi - lo + period >= max(self.min_length, self.times * period)

    def _in_run(self, lo: int, hi: int, size: int) -> bool:
        """Whether the newest stretch, of a period up to `size`, holds [lo, hi): the rest of its own catches."""
        s = self.stretches[-1] if self.stretches else None
        return bool(s) and s[2] <= size and s[0] <= lo and s[1] + s[2] >= hi and self._is_run(*s)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of every maximal run of the words so far, by start and period."""
        for at, h in enumerate(self.level):
            size = LEAST << at
            least = 1 if at == 0 else size
            for k in range(self.waiting[at], (len(self.words) - size) // size + 1):  # blocks that still wait
                q = np.flatnonzero(h[k * size + least : (k + 2) * size] == h[k * size]) + least
                self._merge(np.full(len(q), k * size), q, size)
        found = np.array([(lo, hi + q, q) for lo, hi, q in self.stretches if self._is_run(lo, hi, q)], np.int64).reshape(-1, 3)
        out, at = [], np.lexsort((found[:, 2],))
        for n, i in enumerate(at):  # a run inside one of a smaller period has that period
            less = found[at[:n]]
            if not ((less[:, 0] <= found[i, 0]) & (less[:, 1] >= found[i, 1])).any():
                out.append((int(found[i, 0]), int(found[i, 1] - found[i, 0]), int(found[i, 2])))
        return sorted(out, key=lambda r: (r[0], r[2]))


def _join(left: np.ndarray, right: np.ndarray, at: int) -> np.ndarray:
    x = left * (_SPREAD + np.uint64(2 * at)) + (right ^ (right >> np.uint64(29)))
    return x ^ (x >> np.uint64(32))


def _covered(begin: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether [lo, hi) lies within one of the intervals."""
    order = np.argsort(begin, kind="stable")
    furthest = np.maximum.accumulate(end[order])
    k = np.searchsorted(begin[order], lo, side="right") - 1
    return (k >= 0) & (furthest[np.maximum(k, 0)] >= hi)


def _grow(words: np.ndarray, hi: int, period: int) -> int:
    """The first place from `hi` on whose word differs from the one a period on, or where the words end."""
    step, end = 64, len(words) - period
    while hi < end:
        differ = np.flatnonzero(words[hi : min(hi + step, end)] != words[hi + period : min(hi + step, end) + period])
        if len(differ):
            return hi + int(differ[0])
        hi, step = min(hi + step, end), step * 2
    return hi


def _grow_back(words: np.ndarray, lo: int, period: int) -> int:
    """The first place of the stretch before `lo` in which every word equals the one a period on."""
    step = 64
    while lo > 0:
        low = max(0, lo - step)
        differ = np.flatnonzero(words[low:lo] != words[low + period : lo + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        lo, step = low, step * 2
    return lo


def words_of(text: str | None) -> list[bytes]:
    """Stretches of anything but the six ASCII white-space characters."""
    return (text or "").encode().split()


def runs_of(words: list[bytes], min_length: int = 24, times: int = 3, step: int = 1 << 16) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, which are appended `step` at a time."""
    if len(words) < min_length:
        return []
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    catchers = Catchers(min_length, times)
    for at in range(0, len(ids), step):
        catchers.append(ids[at : at + step])
    return catchers.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, times: int = 3,
              edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row: every maximal run as (start, length, period), ordered by start and
    period, and the text's words without the repetitions, joined by one blank.

    A null text counts as empty; null ids and repeated rows stay as they are; an empty table gives no rows; other
    columns are not read. A text is one row of one task and is held there as one number a word and one hash a
    word for each level of blocks; nothing is shuffled. `edit` may replace the words of a row, given its id, before runs
    are looked for.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for key, text in zip(part.column("id").to_pylist(), part.column("text")):
                    words = words_of(text.as_py())
                    words = edit(key, words) if edit else words
                    runs = runs_of(words, min_length, times)
                    out.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs],
                                b" ".join(collapsed(words, runs)).decode()))
                n, runs, rest = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(runs, kind), pa.array(rest, pa.string())],
                                                 ["id", "n_words", "runs", "collapsed"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def looped(key: int | None, words: list[bytes]) -> list[bytes]:
    """One id in ten (by crc32 of its decimal text) gets a loop: from a word on, the words there repeat. A null id none."""
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digests(found: DataFrame) -> DataFrame:
    """Columns of the registered query from the rows of `find_runs`: the run of the highest exact exponent, hashes of all runs
    and of the collapsed text."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    above = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", F.aggregate("runs", none, above)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
