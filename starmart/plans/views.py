"""Dashboard views v01-v11 over the stored marts, with the dashboard's parameters.

Parameters arrive as Python values and become literal predicates:
``years`` is an inclusive (first, last) pair or None for all years; ``genres``
is a list of selected genres or None for all (an empty list selects nothing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.derive import age_band_rank
from starmart.functions.measures import printf, thousands_dot
from starmart.operators.measures import share_of
from starmart.operators.ordering import asc, desc, ordered, top_k
from starmart.operators.reshape import measures_long, renamed
from starmart.params import (
    AWARDED_TABLE_NAMES,
    FUNNEL_STAGES,
    TOP_COUNTRIES_SHOWN,
    TOP_PUBLISHERS_SHOWN,
    TROPHY_FORMAT,
)

Marts = dict[str, DataFrame]


def _in_years(df: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    return df if years is None else df.filter(F.col("year").between(years[0], years[1]))


def _in_genres(df: DataFrame, genres: Sequence[str] | None) -> DataFrame:
    return df if genres is None else df.filter(F.col("book_genre").isin(*genres))


def v01(marts: Marts, years: tuple[int, int] | None = None) -> DataFrame:
    """KPI totals of the selected years, and the total as display text."""
    d = _in_years(marts["d01"], years)
    totals = d.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"total_{name}")
            for c, name in (
                ("total", "inscricoes"),
                ("semifinalistas", "semifinalistas"),
                ("finalistas", "finalistas"),
                ("vencedores", "vencedores"),
            )
        ]
    )
    return totals.withColumn("total_inscricoes_label", thousands_dot("total_inscricoes"))


def v02(marts: Marts, years: tuple[int, int] | None = None) -> DataFrame:
    """Submissions per year (coloured by period in the chart)."""
    return ordered(_in_years(marts["d01"], years), [asc("year")], [])


def v03(marts: Marts, years: tuple[int, int] | None = None, genres: Sequence[str] | None = None) -> DataFrame:
    """Genres per year for the selected years and genres, summed again by both keys."""
    d = _in_genres(_in_years(marts["d02"], years), genres)
    d = d.filter(F.col("year").isNotNull() & F.col("book_genre").isNotNull())
    out = d.groupBy("year", "book_genre").agg(F.sum("total").cast("long").alias("total"))
    return ordered(out, [asc("year"), asc("book_genre")], [])


def v04(marts: Marts, genres: Sequence[str] | None = None) -> DataFrame:
    """Funnel by genre in long form: one row per genre and stage."""
    d = _in_genres(marts["d04"], genres).withColumn("size", F.col("inscritos"))
    long = measures_long(d, ["book_genre", "size"], FUNNEL_STAGES, "stage", "works")
    # Stage by stage, within a stage in the mart's order (most entries first).
    stages = F.array(*[F.lit(label) for _, label in FUNNEL_STAGES])
    long = long.orderBy(F.array_position(stages, F.col("stage")), desc("size"), asc("book_genre"))
    return long.select("book_genre", "stage", "works")


def v05(marts: Marts, years: tuple[int, int] | None = None) -> DataFrame:
    """Author gender share (%) within each selected year."""
    d = _in_years(marts["d03"], years)
    return ordered(d.withColumn("pct", share_of("total", ["year"], 1)), [asc("year"), asc("author_gender")], [])


def v06(marts: Marts, k: int = TOP_COUNTRIES_SHOWN) -> DataFrame:
    """First-edition countries with most entries."""
    return top_k(marts["d05"], k, [desc("inscricoes")], ["pais"])


def v07(marts: Marts) -> DataFrame:
    """Age bands in natural order; an unknown band loses its label and sorts last."""
    d = marts["d07"].withColumn("__rank", age_band_rank("faixa"))
    d = d.orderBy(F.col("__rank").asc_nulls_last(), desc("inscritos"), asc("faixa"))
    return d.select(F.when(F.col("__rank").isNotNull(), F.col("faixa")).alias("faixa"), "inscritos", "vencedores")


def v08(marts: Marts, k: int = TOP_PUBLISHERS_SHOWN) -> DataFrame:
    """Head of the top-publishers mart."""
    return top_k(marts["d08"], k, [desc("inscricoes")], ["publisher_name", "publication_type"])


def v09(marts: Marts, years: tuple[int, int] | None = None) -> DataFrame:
    """Publication type share (%) within each selected year."""
    d = _in_years(marts["d09"], years)
    return ordered(d.withColumn("pct", share_of("inscricoes", ["year"], 1)), [asc("year"), asc("publication_type")], [])


def v10(marts: Marts) -> DataFrame:
    """Awarded publishers with display names and the trophy label."""
    d = ordered(marts["d10"], [desc("vitorias")], ["publisher_name", "publisher_seat"])
    d = d.withColumn("Vitórias_texto", printf(TROPHY_FORMAT, "vitorias"))
    return renamed(d, AWARDED_TABLE_NAMES)


def v11(marts: Marts) -> DataFrame:
    """Filter options: sorted distinct years and genres (default: all of them)."""
    years = marts["d01"].select("year").distinct()
    genres = marts["d02"].select("book_genre").distinct()
    by_year = years.select(
        F.lit("ano").alias("filtro"),
        F.col("year").cast("string").alias("valor"),
        F.row_number().over(_whole_order("year")).alias("ordem"),
    )
    by_genre = genres.select(
        F.lit("genero_livro").alias("filtro"),
        F.col("book_genre").alias("valor"),
        F.row_number().over(_whole_order("book_genre")).alias("ordem"),
    )
    return by_year.unionByName(by_genre)


def _whole_order(col: str):
    # Over the distinct filter options of a stored mart: a handful of rows.
    return Window.orderBy(F.col(col).asc_nulls_last())


VIEWS = {f.__name__: f for f in (v01, v02, v03, v04, v05, v06, v07, v08, v09, v10, v11)}
