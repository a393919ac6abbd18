"""Unit tests of the scalar rules (FIXTURES.md section 2)."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import pytest

from starmart.functions import (
    age_band_rank,
    decade,
    flag_to_int,
    null_tokens_to_null,
    pct,
    period,
    printf,
    publication_type,
    selection_level,
    thousands_dot,
    unicode_strip,
)
from starmart.params import AGE_BANDS, PRIZE_YEARS


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_strip_matches_python_strip(spark):
    values = [
        "\xa0y\xa0",
        "　a b　",
        "\x85x\x1c",
        " \t\nq\r\n",
        "\x1fz\x1e",
        "",
        "   ",
        "x",
        None,
        "​q​",  # zero-width space is not whitespace
        "ção  ",
        " a  ",
    ]
    got = [r[0] for r in one_col(spark, values).select(unicode_strip("v")).collect()]
    assert got == [None if v is None else v.strip() for v in values]


def test_null_tokens_exact_match_only(spark):
    values = ["NA", " NA ", "", "null", "None", "N/A", "Namibia", "nan", None]
    got = [r[0] for r in one_col(spark, values).select(null_tokens_to_null("v")).collect()]
    assert got == [None, " NA ", None, None, None, None, "Namibia", None, None]


def test_flags(spark):
    values = ["SIM", " sim ", None, "Não", "Sim", "s", "SIM "]
    got = [r[0] for r in one_col(spark, values).select(flag_to_int(unicode_strip("v"))).collect()]
    assert got == [1, 1, 0, 0, 1, 0, 1]


@pytest.mark.parametrize(
    "win,fin,semi,level",
    [
        (1, 0, 0, "Vencedor"),
        (1, 1, 1, "Vencedor"),
        (0, 1, 0, "Finalista"),
        (0, 1, 1, "Finalista"),
        (0, 0, 1, "Semifinalista"),
        (0, 0, 0, "Inscrito"),
    ],
)
def test_selection_level_precedence(spark, win, fin, semi, level):
    df = spark.createDataFrame([(win, fin, semi)], "w int, f int, s int")
    assert df.select(selection_level("w", "f", "s")).first()[0] == level


def test_publication_type(spark):
    values = ["Autopublicação", "AUTOPUBLICAÇÃO", " autopublicação\xa0", "Editora X", None, "Autopublicacao"]
    got = [r[0] for r in one_col(spark, values).select(publication_type("v")).collect()]
    assert got == ["Autopublicação"] * 3 + ["Editora Tradicional"] * 3


def test_decade_and_period_edges(spark):
    years = [2015, 2018, 2019, 2020, 2021, 2022, 2024]
    df = one_col(spark, years, "int")
    rows = df.select(decade("v", PRIZE_YEARS), period("v", PRIZE_YEARS)).collect()
    assert [r[0] for r in rows] == ["2010s", "2010s", "2010s", "2020s", "2020s", "2020s", "2020s"]
    p = PRIZE_YEARS.period_labels
    assert [r[1] for r in rows] == [p[0], p[0], p[1], p[1], p[1], p[2], p[2]]


def test_age_band_rank_unknown_is_null(spark):
    values = list(AGE_BANDS) + ["sem faixa", None]
    got = [r[0] for r in one_col(spark, values).select(age_band_rank("v")).collect()]
    assert got == list(range(1, 10)) + [None, None]


def _half_up(x: int, y: int, n: int) -> float:
    q = Decimal(Fraction(100 * x, y).numerator) / Decimal(Fraction(100 * x, y).denominator)
    return float(q.quantize(Decimal(1).scaleb(-n), rounding="ROUND_HALF_UP"))


def test_pct_half_up_exact(spark):
    pairs = [(x, y) for y in range(1, 81) for x in range(0, y + 1)]
    df = spark.createDataFrame(pairs, "x long, y long")
    for n in (1, 2, 3):
        got = df.select("x", "y", pct("x", "y", n).alias("p")).collect()
        bad = [(r.x, r.y, r.p) for r in got if r.p != _half_up(r.x, r.y, n)]
        assert not bad, bad[:5]


def test_pct_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(0, 0), (3, 0)], "x long, y long")
    assert [r[0] for r in df.select(pct("x", "y", 1)).collect()] == [None, None]


def test_display_formats(spark):
    df = one_col(spark, [16799, 0, 1234567], "long")
    rows = df.select(thousands_dot("v"), printf("%d 🏆", "v")).collect()
    assert [r[0] for r in rows] == ["16.799", "0", "1.234.567"]
    assert [r[1] for r in rows] == ["16799 🏆", "0 🏆", "1234567 🏆"]


def test_strip_property_against_python(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from starmart.functions.text import STRIP_CHARS

    alphabet = st.sampled_from(list(STRIP_CHARS) + list("ab ção​\x00\x1b\x7f­"))
    texts = st.lists(st.text(alphabet=alphabet, max_size=12), min_size=1, max_size=40)

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(texts)
    def check(values):
        got = [r[0] for r in one_col(spark, values).select(unicode_strip("v")).collect()]
        assert got == [v.strip() for v in values]

    check()


def test_strip_of_many_columns_equals_the_strip_of_one(spark):
    from starmart.functions.text import STRIP_CHARS, unicode_strip_all

    texts = [None, "", " ", "a", " a", "a ", "é", "aé ", "\x7f", "a\x7f", "~", "!", "a b", "\xa0 ", "Não", "x\x00", '"q"']
    texts += [f"{c}x" for c in STRIP_CHARS] + [f"x{c}" for c in STRIP_CHARS] + [f"{c}é{c}x" for c in STRIP_CHARS]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, a string, b string")
    rows = unicode_strip_all(df, ["a", "b"]).collect()
    assert rows[0].asDict().keys() == {"i", "a", "b"}
    for r in rows:
        want = None if texts[r["i"]] is None else texts[r["i"]].strip()
        assert r["a"] == want and r["b"] == want, repr(texts[r["i"]])
    # Only text with a white or non-ASCII end is trimmed character by character.
    assert unicode_strip_all(df, []).columns == df.columns
