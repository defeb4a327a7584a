from flowloom.functions.columns import (
    alert_level,
    argmax_index,
    at_least,
    clip_low,
    decide,
    finite,
    half_even,
    is_inf,
    is_missing,
    named,
    numeric,
    ratio,
    seeded_hash,
    squeeze_label,
    string_hash,
    to_places,
    verdict_text,
)

__all__ = [
    "alert_level", "argmax_index", "at_least", "clip_low", "decide", "finite", "half_even",
    "is_inf", "is_missing", "named", "numeric", "ratio", "seeded_hash", "squeeze_label", "string_hash",
    "to_places", "verdict_text",
]
