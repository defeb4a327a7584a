"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a flow file. Anything else is missing,
# including Java spellings such as "1d" that a plain cast would accept.
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def named(name: str) -> Column:
    """Column by exact name; flow features contain dots, slashes and spaces."""
    return F.col(f"`{name}`")


def squeeze_label(label: Column) -> Column:
    """Label without outer white space, in lower case."""
    return F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))


def numeric(text: Column) -> Column:
    """Text to float32: unreadable cells become NULL, infinities stay."""
    text = text.cast("string")
    infinite = F.when(text.contains("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    value = F.when(text.rlike(_DECIMAL), F.trim(text).try_cast("double")).when(text.rlike(_INFINITE), infinite)
    return value.cast("float")


def is_inf(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def is_missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def finite(c: Column) -> Column:
    """The value, or NULL where it is infinite or not a number."""
    return F.when(~(is_inf(c) | F.isnan(c)), c)


def clip_low(c: Column, low: float = 0.0) -> Column:
    """Raise values below `low`; a missing value stays missing."""
    return F.when(c < low, F.lit(float(low))).otherwise(c.cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def half_even(c: Column) -> Column:
    """Nearest whole number, halves to the even one."""
    return F.bround(c, 0).cast("long")


def to_places(c: Column, places: int) -> Column:
    """Scaled, rounded to the even neighbour and scaled back, as array libraries round."""
    scale = F.lit(float(10**places))
    return F.rint(c * scale) / scale


def seeded_hash(seed: int | str, key: Column) -> Column:
    """Uniform hash of seed and row key as 32 hex digits; the same under any partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def string_hash(text: Column) -> Column:
    """Polynomial hash (base 131) of the code points, modulo 2**32 - 1."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0).cast("long"),
        lambda acc, ch: F.when(ch == "", acc).otherwise((acc * 131 + F.ascii(ch)) % F.lit(4294967295)),
    )


def at_least(score: Column, threshold: float | Column) -> Column:
    """score >= threshold; a missing score never reaches it."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False))


def decide(score: Column, threshold: float | Column) -> Column:
    """1 where the score reaches the threshold, else 0."""
    return at_least(score, threshold).cast("int")


def argmax_index(probabilities: Column) -> Column:
    """Index of the largest entry, the first one on ties."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def alert_level(score: Column) -> Column:
    """Three-step alert (fixed steps 0.85 and 0.70)."""
    return (
        F.when(at_least(score, 0.85), "anomaly")
        .when(at_least(score, 0.70), "warning")
        .otherwise("normal")
    )


def verdict_text(prediction: Column) -> Column:
    return F.when(prediction == 1, "ATTACK").otherwise("BENIGN")
