"""Exact quantiles of many columns without holding a column in one task.

`percentile` keeps every distinct value of a column in one aggregation buffer.
Here a quantile sketch, whose rank error is bounded, first narrows each wanted
rank to a short value range; a count checks the range; only the values inside
are grouped and ranked. Columns that are small to begin with skip the narrowing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.functions import finite, named

WIDE = 30  # columns per aggregate, keeps it inside whole-stage code generation


@dataclass
class _Range:
    """Where the rows with rank `first` and `last` (0-based) of a column are known to lie."""

    column: str
    first: int
    last: int
    low: float
    high: float
    below: int
    inside: int

    @property
    def value(self):
        c = finite(named(self.column)).cast("double")
        return F.when(c.between(self.low, self.high), c)

    def loose(self, settle_rows: int) -> bool:
        return self.inside > settle_rows and self.low < self.high


def _chunks(items: Sequence, size: int = WIDE):
    return [items[i : i + size] for i in range(0, len(items), size)]


def _asked(first: float, last: float, accuracy: int) -> list[float]:
    """Probabilities that safely enclose a relative rank, given the sketch's rank error."""
    slack = 2.0 / accuracy
    return [max(0.0, first - slack), min(1.0, last + slack)]


def _sketch(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int):
    """First pass: count, ends and enclosing sketch values of every column."""
    asked = [q for p in probabilities for q in _asked(p, p, accuracy)]
    found = {}
    for part in _chunks(columns):
        cells = []
        for i, c in enumerate(part):
            v = finite(named(c)).cast("double")
            cells.append(F.struct(F.count(v), F.min(v), F.max(v), F.percentile_approx(v, asked, accuracy)).alias(f"_{i}"))
        row = df.agg(*cells).first()
        for i, c in enumerate(part):
            n, low, high, sketch = row[i]
            pairs = [(sketch[k], sketch[k + 1]) for k in range(0, len(asked), 2)] if n else []
            found[c] = (n, low, high, dict(zip(probabilities, pairs)))
    return found


def _confirm(df: DataFrame, ranges: list[_Range], edges: list[tuple[float, float]]) -> bool:
    """Counting pass: take over each proposed range that holds its ranks; true if one got smaller."""
    moved = False
    for part in _chunks(list(zip(ranges, edges))):
        checks = [
            F.struct(F.count_if(r.value < lo), F.count_if(r.value.between(lo, hi))).alias(f"_{i}")
            for i, (r, (lo, hi)) in enumerate(part)
        ]
        counts = df.agg(*checks).first()
        for i, (r, (lo, hi)) in enumerate(part):
            less, within = counts[i]
            below = r.below + less
            if below <= r.first and r.last < below + within and within < r.inside:
                r.low, r.high, r.below, r.inside = lo, hi, below, within
                moved = True
    return moved


def _resketch(df: DataFrame, ranges: list[_Range], accuracy: int) -> list[tuple[float, float]]:
    """Sketch only the values inside each range."""
    edges: list[tuple[float, float]] = []
    for part in _chunks(ranges):
        asks = []
        for i, r in enumerate(part):
            inner = _asked((r.first - r.below) / r.inside, (r.last - r.below + 1) / r.inside, accuracy)
            asks.append(F.percentile_approx(r.value, inner, accuracy).alias(f"_{i}"))
        edges += [tuple(pair) for pair in df.agg(*asks).first()]
    return edges


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    settle_rows: int = 50_000,
    accuracy: int = 10_000,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles over the finite values of each column; None for an empty column.

    Usually three scans of the columns: sketch, count, pick. Ranges that still
    hold more than `settle_rows` rows are sketched and counted again.
    """
    first_pass = _sketch(df, columns, probabilities, accuracy)
    ranges: dict[tuple, _Range] = {}
    for c in columns:
        n, low, high, _ = first_pass[c]
        for p in probabilities if n else ():
            at = (n - 1) * p
            ranges[c, p] = _Range(c, math.floor(at), min(math.floor(at) + 1, n - 1), low, high, 0, n)

    loose = [k for k, r in ranges.items() if r.loose(settle_rows)]
    edges = [first_pass[c][3][p] for c, p in loose]
    while loose and _confirm(df, [ranges[k] for k in loose], edges):
        loose = [k for k in loose if ranges[k].loose(settle_rows)]
        edges = _resketch(df, [ranges[k] for k in loose], accuracy)

    picked = _values_at(df, list(ranges.values()))
    result: dict[str, list[float | None]] = {}
    for c in columns:
        n = first_pass[c][0]
        cells = []
        for p in probabilities if n else ():
            r, at = ranges[c, p], (n - 1) * p
            low, high = picked[c, r.first], picked[c, r.last]
            cells.append(low + (high - low) * (at - math.floor(at)))
        result[c] = cells or [None] * len(probabilities)
    return result


def _values_at(df: DataFrame, ranges: list[_Range]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks: distinct values of each range are counted, then ranked."""
    found = {}
    shared: dict[tuple, set[int]] = {}
    for r in ranges:
        if r.low == r.high:
            found[r.column, r.first] = found[r.column, r.last] = r.low
        else:
            shared.setdefault((r.column, r.low, r.high, r.below), set()).update((r.first, r.last))
    for part in _chunks(list(shared.items())):
        cells, wanted = [], []
        for i, ((column, low, high, below), ranks) in enumerate(part):
            value = finite(named(column)).cast("double")
            cells.append(F.when(value.between(low, high), F.struct(F.lit(i).alias("r"), value.alias("v"))))
            wanted.append(sorted(k - below for k in ranks))
        values = df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy("x.r", "x.v")
        counted = values.agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(W.partitionBy("r").orderBy("v"))
        ranks_of = F.array(*[F.array(*[F.lit(k) for k in ks]) for ks in wanted])[F.col("r")]
        hits = counted.withColumn("upto", upto).withColumn(
            "ranks", F.filter(ranks_of, lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))
        )
        for row in hits.where(F.size("ranks") > 0).select("r", "v", "ranks").collect():
            (column, _, _, below), _ = part[row.r]
            found.update({(column, k + below): row.v for k in row.ranks})
    return found
