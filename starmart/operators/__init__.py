"""Relational building blocks composed from DataFrame operators."""

from starmart.operators.clean import clean_submissions, string_columns
from starmart.operators.dedupe import chosen_rows, keep_first, keep_latest, take_rows
from starmart.operators.dense_ids import with_dense_id
from starmart.operators.lookup import (
    broadcast_if_within,
    hot_keys,
    null_safe_lookup,
    stored_bytes,
    stored_rows,
)
from starmart.operators.measures import fact_measures, measures_by, share_of
from starmart.operators.ordering import asc, desc, ordered, top_k
from starmart.operators.reshape import measures_long, renamed
from starmart.operators.spread import scan_splits, spread

__all__ = [
    "asc",
    "broadcast_if_within",
    "chosen_rows",
    "clean_submissions",
    "desc",
    "fact_measures",
    "hot_keys",
    "keep_first",
    "keep_latest",
    "measures_by",
    "measures_long",
    "null_safe_lookup",
    "ordered",
    "renamed",
    "scan_splits",
    "share_of",
    "spread",
    "stored_bytes",
    "stored_rows",
    "string_columns",
    "take_rows",
    "top_k",
    "with_dense_id",
]
