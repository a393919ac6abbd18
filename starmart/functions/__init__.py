"""Scalar column expressions: cleaning, derived categories, measures and display formats."""

from starmart.functions.derive import age_band_rank, decade, period, publication_type, selection_level
from starmart.functions.measures import pct, printf, thousands_dot
from starmart.functions.text import STRIP_CHARS, flag_to_int, null_tokens_to_null, unicode_strip

__all__ = [
    "STRIP_CHARS",
    "age_band_rank",
    "decade",
    "flag_to_int",
    "null_tokens_to_null",
    "pct",
    "period",
    "printf",
    "publication_type",
    "selection_level",
    "thousands_dot",
    "unicode_strip",
]
