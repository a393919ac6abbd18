"""Ad-hoc SQL over the warehouse (S2): the star under its own names and under the
source application's names, against the DataFrame reports."""

from __future__ import annotations

from pyspark.sql import functions as F


def test_source_names_join_to_the_same_rows(spark, small_star):
    """Each foreign key resolves under the source names: titles of winning works per
    publisher, as nested lists, equal those of the star's own columns."""
    small_star.register_views(source_names=True)
    got = spark.sql("""
        WITH winners AS (
          SELECT id_livro, id_editora, id_autor FROM fato_inscricao WHERE indicador_vencedor = 1)
        SELECT e.nome_editora AS house, sort_array(collect_set(concat_ws('/', l.titulo_livro, a.nome_autor))) AS works
        FROM winners
        LEFT JOIN dim_editora e USING (id_editora)
        LEFT JOIN dim_livro l USING (id_livro)
        LEFT JOIN dim_autor a USING (id_autor)
        GROUP BY ALL""")
    fact = small_star.fact_submission.where("is_winner = 1")
    own = (
        fact.join(small_star.dim_publisher, "publisher_id")
        .join(small_star.dim_book.drop("author_name"), "book_id")
        .join(small_star.dim_author, "author_id")
        .groupBy(F.col("publisher_name").alias("house"))
        .agg(F.sort_array(F.collect_set(F.concat_ws("/", "title", "author_name"))).alias("works"))
    )
    assert got.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, own.collect()))


def test_source_names_of_the_time_table(spark, small_star):
    small_star.register_views(source_names=True)
    got = spark.sql("SELECT max_by(periodo, ano) AS last, count_if(decada = '1990s') AS nineties FROM dim_tempo").first()
    assert (got["last"], got["nineties"]) == ("Consolidação (2000-2001)", 5)


def test_sql_with_build_names(spark, small_star):
    small_star.register_views()
    got = {r["selection_level"]: r["n"] for r in spark.sql("SELECT selection_level, COUNT(*) AS n FROM fact_submission GROUP BY ALL").collect()}
    assert sum(got.values()) == 6000
    assert set(got) <= {"Vencedor", "Finalista", "Semifinalista", "Inscrito"}
