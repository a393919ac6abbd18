
from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from starmart.params import PRIZE_YEARS
from starmart.plans import reports, views
from starmart.plans.marts import build_marts
from starmart.plans.star import build_star

from conftest import raw_frame


@pytest.fixture(scope="module")
def marts(spark, small_star):
    return build_marts(spark, small_star)


def test_totals_add_up(small_star):
    assert sum(r.total_inscricoes for r in reports.q01(small_star).collect()) == 6000
    assert sum(r.inscritos for r in reports.q05(small_star).collect()) == 6000
    assert sum(r.inscritos for r in reports.q07(small_star).collect()) == 6000


def test_shares_add_to_100(small_star):
    for df, col in ((reports.q03(small_star), "pct"), (reports.q12(small_star), "pct_do_ano")):
        by_year = {}
        for r in df.collect():
            by_year[r.year] = by_year.get(r.year, 0) + r[col]
        assert all(abs(v - 100) <= 0.2 for v in by_year.values())
    assert abs(sum(r.pct_inscritos for r in reports.q07(small_star).collect()) - 100) <= 0.2


def test_filters_and_limits(small_star):
    assert reports.q10(small_star).count() <= 15
    assert all(r.vitorias > 0 for r in reports.q11(small_star).collect())
    assert all(r.inscricoes >= 10 for r in reports.q06(small_star).collect())
    assert all(r.inscricoes >= 5 for r in reports.q09(small_star).collect())
    assert all(r.author_age_band != "Não informado" for r in reports.q08(small_star).collect())


def test_report_order(small_star):
    rows = reports.q02(small_star).collect()
    keys = [(r.year, -r.total, r.book_genre) for r in rows]
    assert keys == sorted(keys)


def test_no_winners_gives_null_share(spark):
    star = build_star(spark, raw_frame(spark, [{}, {"nome_autor": "Beto", "genero_autor": "Masculino"}]), PRIZE_YEARS, dataset=f"test-nowin-{uuid.uuid4().hex[:6]}")
    rows = reports.q07(star).collect()
    assert [r.pct_vencedores for r in rows] == [None, None]
    assert sorted(r.pct_inscritos for r in rows) == [50.0, 50.0]


def test_year_and_genre_filters_match_brute_force(marts):
    d02 = marts["d02"].toPandas()
    years, genres = (1996, 1998), ["SMALL", "PROMO"]
    got = {(r.year, r.book_genre): r.total for r in views.v03(marts, years, genres).collect()}
    sel = d02[d02.year.between(*years) & d02.book_genre.isin(genres)]
    exp = sel.groupby(["year", "book_genre"])["total"].sum().to_dict()
    assert got == exp and len(got) == 6


def test_empty_genre_selection_gives_no_rows(marts):
    assert views.v03(marts, None, []).count() == 0
    assert views.v04(marts, []).count() == 0


def test_kpis_over_year_range(marts):
    d01 = marts["d01"].toPandas()
    row = views.v01(marts, (1997, 1999)).first()
    sel = d01[d01.year.between(1997, 1999)]
    assert row.total_inscricoes == sel.total.sum()
    assert row.total_vencedores == sel.vencedores.sum()
    assert row.total_inscricoes_label == f"{int(sel.total.sum()):,}".replace(",", ".")
    empty = views.v01(marts, (1900, 1901)).first()
    assert (empty.total_inscricoes, empty.total_inscricoes_label) == (0, "0")


def test_share_views_within_selected_years(marts):
    rows = views.v05(marts, (1998, 1999)).collect()
    assert {r.year for r in rows} == {1998, 1999}
    for y in (1998, 1999):
        assert abs(sum(r.pct for r in rows if r.year == y) - 100) <= 0.2


def test_age_view_unknown_band_last(spark):
    d07 = spark.createDataFrame(
        [("de 40 a 50 anos", 5, 1), ("sem faixa", 9, 0), ("menos de 20 anos", 2, 0)], "faixa string, inscritos long, vencedores long"
    )
    rows = views.v07({"d07": d07}).collect()
    assert [r.faixa for r in rows] == ["menos de 20 anos", "de 40 a 50 anos", None]


def test_funnel_long_form(marts):
    rows = views.v04(marts, ["SMALL"]).collect()
    assert [r.stage for r in rows] == ["Inscritos", "Semifinalistas", "Finalistas", "Vencedores"]
    d04 = marts["d04"].filter(F.col("book_genre") == "SMALL").first()
    assert [r.works for r in rows] == [d04.inscritos, d04.semifinalistas, d04.finalistas, d04.vencedores]


def test_heads(marts):
    assert views.v06(marts).count() == min(8, marts["d05"].count())
    top = views.v08(marts).collect()
    assert len(top) == min(12, marts["d08"].count())
    assert [r.inscricoes for r in top] == sorted((r.inscricoes for r in top), reverse=True)


def test_awarded_table_names(marts):
    df = views.v10(marts)
    assert df.columns == ["Editora", "Sede", "Inscrições", "Finalistas", "Vitórias", "Vitórias_texto"]
    r = df.first()
    assert r["Vitórias_texto"] == f"{r['Vitórias']} 🏆"


def test_stored_marts_equal_reports_on_the_fact(small_star, marts):
    for name, report in reports.DASHBOARD.items():
        live = report(small_star)
        stored = marts[name].select(*live.columns)
        assert live.count() == stored.count(), name
        assert live.exceptAll(stored).count() == 0, name
