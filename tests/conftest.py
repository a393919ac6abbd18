from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[*]")
        .appName("starmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session names none.
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-tests-"))
    yield spark


@pytest.fixture(scope="session")
def small_star(spark):
    from starmart.datasets import testdata_star

    return testdata_star(spark, SF_SMALL)


RAW_DEFAULTS = {
    "ano": 2015,
    "titulo_livro": "Livro",
    "genero_livro": "Romance",
    "pais_primeira_edicao": "Brasil",
    "nome_autor": "Autora",
    "genero_autor": "Feminino",
    "faixa_etaria_autor": "de 30 a 40 anos",
    "nacionaldade_autor": "Brasileira",
    "nome_pais_autor": "Brasil",
    "sigla_pais_iso2": "BR",
    "nome_editora": "Editora A",
    "sede_editora": "São Paulo",
    "site_editora": "https://a",
    "indicador_semifinalista": "Não",
    "indicador_finalista": "Não",
    "indicador_vencedor": "Não",
}


def raw_frame(spark, rows: list[dict]):
    """Raw submissions from partial dicts; the list position is the row key."""
    from starmart.sources.schemas import RAW_COLUMNS, RAW_SCHEMA

    data = [(i, *[{**RAW_DEFAULTS, **r}[c] for c in RAW_COLUMNS]) for i, r in enumerate(rows)]
    schema = "row_pos long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    from pyspark.sql import functions as F

    df = spark.createDataFrame(data, schema)
    return df.select(F.struct("row_pos").alias("row_key"), *RAW_COLUMNS)
