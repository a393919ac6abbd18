"""Explicit schemas: the raw submissions contract and the star-schema tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw columns keep the names of the source file (they are the file
# contract). Files are bound by these names, in any order.
RAW_COLUMNS = (
    "ano",
    "titulo_livro",
    "genero_livro",
    "pais_primeira_edicao",
    "nome_autor",
    "genero_autor",
    "faixa_etaria_autor",
    "nacionaldade_autor",
    "nome_pais_autor",
    "sigla_pais_iso2",
    "nome_editora",
    "sede_editora",
    "site_editora",
    "indicador_semifinalista",
    "indicador_finalista",
    "indicador_vencedor",
)

RAW_SCHEMA = T.StructType(
    [T.StructField("ano", T.IntegerType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[1:]]
)

FLAG_COLUMNS = ("indicador_vencedor", "indicador_finalista", "indicador_semifinalista")

# Null fills applied after stripping (a whitespace-only cell is '' and is not filled).
def fill_values():
    from starmart.params import NO_COUNTRY_CODE, NO_SITE, NOT_INFORMED

    return {
        "genero_autor": NOT_INFORMED,
        "faixa_etaria_autor": NOT_INFORMED,
        "nome_pais_autor": NOT_INFORMED,
        "nacionaldade_autor": NOT_INFORMED,
        "sede_editora": NOT_INFORMED,
        "site_editora": NO_SITE,
        "sigla_pais_iso2": NO_COUNTRY_CODE,
    }


# Hidden column that carries the source row order (first raw row wins in dedupes).
ROW_KEY = "row_key"

DIM_AUTHOR_COLUMNS = (
    "author_id",
    "author_name",
    "author_gender",
    "author_age_band",
    "author_nationality",
    "author_country",
    "author_country_iso2",
)
DIM_BOOK_COLUMNS = ("book_id", "title", "book_genre", "first_edition_country", "author_name")
DIM_PUBLISHER_COLUMNS = (
    "publisher_id",
    "publisher_name",
    "publisher_seat",
    "publisher_site",
    "publication_type",
)
FACT_COLUMNS = (
    "submission_id",
    "time_id",
    "author_id",
    "book_id",
    "publisher_id",
    "is_winner",
    "is_finalist",
    "is_semifinalist",
    "selection_level",
)
