"""Cleaning of raw submissions: strip text, fill missing categories, parse flags,
derive the selection level and the publication type. Narrow (map-side) only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.derive import publication_type, selection_level
from starmart.functions.text import flag_to_int, unicode_strip_all
from starmart.sources.schemas import FLAG_COLUMNS, fill_values


def string_columns(df: DataFrame) -> list[str]:
    """Names of the top-level text columns (the ones every cleaning step touches)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_submissions(raw: DataFrame) -> DataFrame:
    """Raw rows -> cleaned rows plus ``selection_level`` and ``publication_type``.

    Order matters and follows the source ETL: strip first (so a whitespace-only
    cell becomes '' and is *not* filled), then fill, then parse the flags.
    Everything is narrow; the strip is one expression over all text columns.
    """
    texts = unicode_strip_all(raw, string_columns(raw))
    fills = fill_values()
    cols = []
    for name in raw.columns:
        c = F.col(name)
        if name in fills:
            c = F.coalesce(c, F.lit(fills[name]))
        if name in FLAG_COLUMNS:
            c = flag_to_int(c)
        cols.append(c.alias(name))
    stripped = texts.select(*cols)
    return stripped.withColumns(
        {
            "selection_level": selection_level(
                "indicador_vencedor", "indicador_finalista", "indicador_semifinalista"
            ),
            "publication_type": publication_type("nome_editora"),
        }
    )
