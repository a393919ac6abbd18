"""The analytical reports over the star: q01-q12 (ad-hoc SQL set) and d01-d10
(dashboard aggregates). Each takes a ``Star`` and returns an ordered DataFrame.

Fixed values: the output names of measures and renamed attributes
(``inscritos``, ``taxa_semi_pct``, ``pais_autor``, ...) are those of the source
reports and must stay as they are; dimension attributes otherwise keep the star's
column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.measures import pct
from starmart.operators.measures import measures_by, share_of
from starmart.operators.ordering import asc, desc, ordered, top_k
from starmart.params import (
    COMPARED_GENDERS,
    MIN_ENTRIES_AUTHOR_COUNTRY,
    MIN_ENTRIES_BOOK_COUNTRY,
    MIN_ENTRIES_DASHBOARD_COUNTRY,
    NOT_INFORMED,
    TOP_PUBLISHERS,
)
from starmart.sources.warehouse import Star


def _dim(star: Star, table: str, id_col: str, cols, where=None):
    d = getattr(star, table).select(id_col, *cols)
    return (d.filter(where) if where is not None else d), id_col, star.broadcast_rows(table)


def _time(star: Star, *cols: str):
    return _dim(star, "dim_time", "time_id", cols)


def _author(star: Star, *cols: str, where=None):
    return _dim(star, "dim_author", "author_id", cols, where)


def _book(star: Star, *cols: str):
    return _dim(star, "dim_book", "book_id", cols)


def _publisher(star: Star, *cols: str):
    return _dim(star, "dim_publisher", "publisher_id", cols)


def _measures(star: Star, dims, group, names: dict[str, str]) -> DataFrame:
    """Measures named in ``names`` (n/semi/fin/win -> output name), grouped."""
    df = measures_by(star.fact_submission, dims, group, tuple(names))
    return df.withColumnsRenamed(names)


def _gender_in():
    return F.col("author_gender").isin(*COMPARED_GENDERS)


def _band_known():
    return F.col("author_age_band") != NOT_INFORMED


def _country_known():
    return F.col("author_country") != NOT_INFORMED


# --- Theme 1: evolution over time ------------------------------------------


def q01(star: Star) -> DataFrame:
    """Submissions per year."""
    df = _measures(star, [_time(star, "year", "period")], ["year", "period"], {"n": "total_inscricoes"})
    return ordered(df, [asc("year")], ["period"])


def q02(star: Star) -> DataFrame:
    """Book genres per year."""
    df = _measures(
        star, [_time(star, "year"), _book(star, "book_genre")], ["year", "book_genre"], {"n": "total"}
    )
    return ordered(df, [asc("year"), desc("total")], ["book_genre"])


def q03(star: Star) -> DataFrame:
    """Women's and men's share of each year's submissions."""
    df = _measures(
        star,
        [_time(star, "year"), _author(star, "author_gender", where=_gender_in())],
        ["year", "author_gender"],
        {"n": "total"},
    )
    df = df.withColumn("pct", share_of("total", ["year"], 1))
    return ordered(df, [asc("year"), asc("author_gender")], [])


# --- Theme 2: selection funnel ---------------------------------------------


def q04(star: Star) -> DataFrame:
    """Full funnel per year with three conversion rates."""
    names = {"n": "inscritos", "semi": "semifinalistas", "fin": "finalistas", "win": "vencedores"}
    df = _measures(star, [_time(star, "year")], ["year"], names)
    df = df.select(
        "*",
        pct("semifinalistas", "inscritos", 1).alias("taxa_semi_pct"),
        pct("finalistas", "inscritos", 2).alias("taxa_final_pct"),
        pct("vencedores", "inscritos", 3).alias("taxa_vitoria_pct"),
    )
    return ordered(df, [asc("year")], [])


def q05(star: Star) -> DataFrame:
    """Winner conversion by book genre."""
    names = {"n": "inscritos", "semi": "semifinalistas", "fin": "finalistas", "win": "vencedores"}
    df = _measures(star, [_book(star, "book_genre")], ["book_genre"], names)
    df = df.withColumn("taxa_vitoria_pct", pct("vencedores", "inscritos", 2))
    return ordered(df, [desc("taxa_vitoria_pct")], ["book_genre"])


def q06(star: Star) -> DataFrame:
    """Wins by the book's first-edition country (countries with >= 10 entries)."""
    df = _measures(
        star, [_book(star, "first_edition_country")], ["first_edition_country"], {"n": "inscricoes", "win": "vitorias"}
    )
    df = df.filter(F.col("inscricoes") >= MIN_ENTRIES_BOOK_COUNTRY).withColumn(
        "taxa_vitoria_pct", pct("vitorias", "inscricoes", 2)
    )
    return ordered(df, [desc("vitorias")], ["first_edition_country"])


# --- Theme 3: diversity ----------------------------------------------------


def q07(star: Star) -> DataFrame:
    """Author gender: share of entrants against share of winners."""
    df = _measures(star, [_author(star, "author_gender")], ["author_gender"], {"n": "inscritos", "win": "vencedores"})
    df = df.select(
        "*",
        share_of("inscritos", [], 1).alias("pct_inscritos"),
        share_of("vencedores", [], 1).alias("pct_vencedores"),
    )
    return ordered(df, [desc("inscritos")], ["author_gender"])


def q08(star: Star) -> DataFrame:
    """Age profile: entrants, winners and win rate per known age band."""
    df = _measures(
        star,
        [_author(star, "author_age_band", where=_band_known())],
        ["author_age_band"],
        {"n": "inscritos", "win": "vencedores"},
    )
    df = df.withColumn("taxa_vitoria_pct", pct("vencedores", "inscritos", 2))
    return ordered(df, [desc("inscritos")], ["author_age_band"])


def q09(star: Star) -> DataFrame:
    """Author countries with >= 5 entries: entries and funnel counts."""
    names = {"n": "inscricoes", "semi": "semifinalistas", "fin": "finalistas", "win": "vitorias"}
    df = _measures(
        star,
        [_author(star, "author_country", where=_country_known())],
        [F.col("author_country").alias("pais_autor")],
        names,
    )
    df = df.filter(F.col("inscricoes") >= MIN_ENTRIES_AUTHOR_COUNTRY)
    return ordered(df, [desc("inscricoes")], ["pais_autor"])


# --- Theme 4: publishing market ---------------------------------------------


def q10(star: Star) -> DataFrame:
    """Top 15 publishers by entries."""
    names = {"n": "inscricoes", "semi": "semifinalistas", "fin": "finalistas", "win": "vitorias"}
    keys = ["publisher_name", "publication_type", "publisher_seat"]
    df = _measures(star, [_publisher(star, *keys)], keys, names)
    return top_k(df, TOP_PUBLISHERS, [desc("inscricoes")], keys)


def q11(star: Star) -> DataFrame:
    """Publishers with at least one win."""
    keys = ["publisher_name", "publisher_seat"]
    df = _measures(star, [_publisher(star, *keys)], keys, {"n": "inscricoes", "fin": "finalistas", "win": "vitorias"})
    return ordered(df.filter(F.col("vitorias") > 0), [desc("vitorias")], keys)


def q12(star: Star) -> DataFrame:
    """Self-published against traditional publishers, share of each year."""
    df = _measures(
        star,
        [_time(star, "year"), _publisher(star, "publication_type")],
        ["year", "publication_type"],
        {"n": "inscricoes"},
    )
    df = df.withColumn("pct_do_ano", share_of("inscricoes", ["year"], 1))
    return ordered(df, [asc("year"), asc("publication_type")], [])


# --- Dashboard aggregates ---------------------------------------------------


def d01(star: Star) -> DataFrame:
    """Per year: entries and funnel counts."""
    names = {"n": "total", "semi": "semifinalistas", "fin": "finalistas", "win": "vencedores"}
    df = _measures(star, [_time(star, "year", "period")], ["year", "period"], names)
    return ordered(df, [asc("year")], ["period"])


def d02(star: Star) -> DataFrame:
    df = _measures(
        star, [_time(star, "year"), _book(star, "book_genre")], ["year", "book_genre"], {"n": "total"}
    )
    return ordered(df, [asc("year")], ["book_genre"])


def d03(star: Star) -> DataFrame:
    df = _measures(
        star,
        [_time(star, "year"), _author(star, "author_gender", where=_gender_in())],
        ["year", "author_gender"],
        {"n": "total"},
    )
    return ordered(df, [asc("year")], ["author_gender"])


def d04(star: Star) -> DataFrame:
    names = {"n": "inscritos", "semi": "semifinalistas", "fin": "finalistas", "win": "vencedores"}
    df = _measures(star, [_book(star, "book_genre")], ["book_genre"], names)
    df = df.withColumn("taxa_pct", pct("vencedores", "inscritos", 2))
    return ordered(df, [desc("inscritos")], ["book_genre"])


def d05(star: Star) -> DataFrame:
    df = _measures(
        star,
        [_book(star, "first_edition_country")],
        [F.col("first_edition_country").alias("pais")],
        {"n": "inscricoes", "win": "vitorias"},
    )
    df = df.filter(F.col("inscricoes") >= MIN_ENTRIES_DASHBOARD_COUNTRY)
    return ordered(df, [desc("inscricoes")], ["pais"])


def d06(star: Star) -> DataFrame:
    df = _measures(star, [_author(star, "author_gender")], ["author_gender"], {"n": "inscritos", "win": "vencedores"})
    return ordered(df, [desc("inscritos")], ["author_gender"])


def d07(star: Star) -> DataFrame:
    df = _measures(
        star,
        [_author(star, "author_age_band", where=_band_known())],
        [F.col("author_age_band").alias("faixa")],
        {"n": "inscritos", "win": "vencedores"},
    )
    return ordered(df, [desc("inscritos")], ["faixa"])


def d08(star: Star) -> DataFrame:
    keys = ["publisher_name", "publication_type"]
    df = _measures(star, [_publisher(star, *keys)], keys, {"n": "inscricoes", "win": "vitorias"})
    return top_k(df, TOP_PUBLISHERS, [desc("inscricoes")], keys)


def d09(star: Star) -> DataFrame:
    df = _measures(
        star,
        [_time(star, "year"), _publisher(star, "publication_type")],
        ["year", "publication_type"],
        {"n": "inscricoes"},
    )
    return ordered(df, [asc("year")], ["publication_type"])


def d10(star: Star) -> DataFrame:
    keys = ["publisher_name", "publisher_seat"]
    df = _measures(star, [_publisher(star, *keys)], keys, {"n": "inscricoes", "fin": "finalistas", "win": "vitorias"})
    return ordered(df.filter(F.col("vitorias") > 0), [desc("vitorias")], keys)


REPORTS = {f.__name__: f for f in (q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12)}
DASHBOARD = {f.__name__: f for f in (d01, d02, d03, d04, d05, d06, d07, d08, d09, d10)}
