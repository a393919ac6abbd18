"""CSV source (null tokens, multi-line cells) and the cleaning order."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

import pytest

from starmart.operators.clean import clean_submissions
from starmart.sources.csv import read_submissions_csv, write_submissions_csv
from starmart.sources.schemas import RAW_COLUMNS

from conftest import raw_frame

HEADER = ",".join(RAW_COLUMNS)


def _line(**cells):
    from conftest import RAW_DEFAULTS

    vals = {**RAW_DEFAULTS, **cells}
    return ",".join(str(vals[c]) for c in RAW_COLUMNS)


def test_csv_null_tokens_multiline_and_quotes(spark):
    lines = [
        HEADER,
        _line(sigla_pais_iso2="NA"),
        _line(sigla_pais_iso2='" NA "'),
        _line(genero_autor='"   "'),
        _line(genero_autor='""'),
        _line(titulo_livro='"l1\nl2"', nome_autor='"he said ""oi"""'),
        _line(nome_autor="\xa0Ana\xa0", indicador_vencedor='" sim "', indicador_finalista=""),
    ]
    folder = tempfile.mkdtemp(prefix="starmart-csv-")
    with open(os.path.join(folder, "part.csv"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = read_submissions_csv(spark, folder)
    assert "row_key" in raw.columns
    rows = clean_submissions(raw).orderBy("row_key").collect()
    assert len(rows) == 6
    assert rows[0].sigla_pais_iso2 == "XX"  # token -> null -> fill
    assert rows[1].sigla_pais_iso2 == "NA"  # padded token stays text, then stripped
    assert rows[2].genero_autor == ""  # whitespace only: stripped to '' and not filled
    assert rows[3].genero_autor == "Não informado"  # quoted empty: null, filled
    assert rows[4].titulo_livro == "l1\nl2"
    assert rows[4].nome_autor == 'he said "oi"'
    assert rows[5].nome_autor == "Ana"
    assert (rows[5].indicador_vencedor, rows[5].indicador_finalista) == (1, 0)
    assert rows[5].selection_level == "Vencedor"


def test_csv_roundtrip_keeps_padding(spark):
    raw = raw_frame(spark, [{"nome_autor": "  Bia "}, {"nome_editora": " Autopublicação"}])
    folder = tempfile.mkdtemp(prefix="starmart-csv-")
    write_submissions_csv(raw, folder)
    back = read_submissions_csv(spark, folder)
    assert sorted(r.nome_autor for r in back.collect()) == ["  Bia ", "Autora"]
    cleaned = clean_submissions(back).collect()
    assert {r.publication_type for r in cleaned} == {"Autopublicação", "Editora Tradicional"}


def test_clean_fills_and_levels(spark):
    raw = raw_frame(
        spark,
        [
            {"genero_autor": None, "site_editora": None, "sigla_pais_iso2": None, "sede_editora": None},
            {"indicador_semifinalista": "Sim", "indicador_finalista": "SIM", "indicador_vencedor": None},
        ],
    )
    rows = clean_submissions(raw).orderBy("row_key").collect()
    assert rows[0].genero_autor == "Não informado"
    assert rows[0].site_editora == ""
    assert rows[0].sigla_pais_iso2 == "XX"
    assert rows[0].sede_editora == "Não informado"
    assert rows[0].selection_level == "Inscrito"
    assert rows[1].selection_level == "Finalista"


def test_non_integer_year_fails_the_read(spark):
    folder = tempfile.mkdtemp(prefix="starmart-csv-")
    with open(os.path.join(folder, "part.csv"), "w", encoding="utf-8") as fh:
        fh.write(HEADER + "\n" + _line(ano="dois mil") + "\n")
    with pytest.raises(Exception):
        read_submissions_csv(spark, folder).collect()


def _write(folder, name, header, *lines):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join([",".join(header), *lines]) + "\n")


def test_columns_are_bound_by_header(spark, tmp_path):
    order = ["extra", *reversed(RAW_COLUMNS)]
    cells = {c: c.upper() for c in RAW_COLUMNS} | {"ano": "2017", "extra": "?"}
    _write(tmp_path, "part.csv", order, ",".join(cells[c] for c in order))
    row = read_submissions_csv(spark, str(tmp_path)).first()
    assert row["ano"] == 2017 and all(row[c] == c.upper() for c in RAW_COLUMNS if c != "ano")


def test_missing_column_is_an_error(spark, tmp_path):
    _write(tmp_path, "part.csv", RAW_COLUMNS[:-1], ",".join("1" for _ in RAW_COLUMNS[:-1]))
    with pytest.raises(ValueError, match="indicador_vencedor"):
        read_submissions_csv(spark, str(tmp_path))


def test_mixed_headers_are_an_error(spark, tmp_path):
    _write(tmp_path, "part-0.csv", RAW_COLUMNS, _line())
    swapped = ["ano", "nome_autor", "genero_livro", "pais_primeira_edicao", "titulo_livro", *RAW_COLUMNS[5:]]
    _write(tmp_path, "part-1.csv", swapped, _line())
    with pytest.raises(Exception):
        read_submissions_csv(spark, str(tmp_path)).collect()


def test_missing_years_are_null_and_other_text_fails(spark, tmp_path):
    _write(tmp_path, "part.csv", RAW_COLUMNS, _line(ano="NA"), _line(ano=""), _line(ano="2019"))
    assert [r["ano"] for r in read_submissions_csv(spark, str(tmp_path)).orderBy("row_key").collect()] == [None, None, 2019]


def test_keep_latest_takes_a_known_year_over_a_missing_one(spark):
    from starmart.plans.star import dim_author_rows

    rows = [{"ano": None, "genero_autor": "a"}, {"ano": 2020, "genero_autor": "b"}, {"nome_autor": "N", "ano": None, "genero_autor": "c"}, {"nome_autor": "N", "ano": None, "genero_autor": "d"}]
    picked = {r["author_name"]: r["author_gender"] for r in dim_author_rows(clean_submissions(raw_frame(spark, rows))).collect()}
    assert picked == {"Autora": "b", "N": "c"}


def test_cli_loads_and_reports_in_two_processes(spark, tmp_path):
    raw = raw_frame(
        spark,
        [{"ano": 2015 + i % 10, "nome_autor": f"A{i % 7}", "indicador_vencedor": "Sim" if i % 9 == 0 else "Não"} for i in range(40)],
    )
    write_submissions_csv(raw, str(tmp_path / "csv"))

    def run(*arguments):
        env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
        command = [sys.executable, "-m", "starmart", *arguments]
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        return subprocess.run(command, cwd=root, env=env, capture_output=True, text=True, timeout=300)

    root = ("--root", str(tmp_path / "warehouse"))
    out = run("etl", str(tmp_path / "csv"), "prize", *root).stdout
    assert "  fact_submission : 40" in out and "  raw             : 40" in out
    out = run("report", "prize", "v02", *root, "--years", "2016", "2018").stdout
    assert "|2017|" in out and "|2015|" not in out
    assert run("report", "prize", "q04", *root, "--out", str(tmp_path / "q04")).returncode == 0
    assert spark.read.parquet(str(tmp_path / "q04")).count() == 10
    assert not list((tmp_path / "warehouse").glob("**/_work"))


def test_single_line_mode_reads_the_same_rows(spark):
    raw = raw_frame(spark, [{"nome_autor": f"  A{i} ", "indicador_vencedor": "SIM" if i % 3 else None} for i in range(30)])
    folder = tempfile.mkdtemp(prefix="starmart-csv-")
    write_submissions_csv(raw, folder)
    a = clean_submissions(read_submissions_csv(spark, folder)).drop("row_key")
    b = clean_submissions(read_submissions_csv(spark, folder, multiline=False)).drop("row_key")
    assert a.count() == 30 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_first_raw_row_follows_file_order(spark):
    import uuid

    from starmart.params import PRIZE_YEARS
    from starmart.plans.star import build_star

    folder = tempfile.mkdtemp(prefix="starmart-csv-")
    # The first file is the smaller one, so Spark schedules it last; the row key
    # (file, split start, position) still puts its rows first.
    with open(os.path.join(folder, "part-00000.csv"), "w", encoding="utf-8") as fh:
        fh.write(HEADER + "\n" + _line(nome_editora="Editora P", sede_editora="primeira") + "\n")
    with open(os.path.join(folder, "part-00001.csv"), "w", encoding="utf-8") as fh:
        rows = [_line(nome_editora="Editora P", sede_editora="segunda", titulo_livro=f"T{i}") for i in range(200)]
        fh.write(HEADER + "\n" + "\n".join(rows) + "\n")
    star = build_star(spark, read_submissions_csv(spark, folder), PRIZE_YEARS, dataset=f"test-order-{uuid.uuid4().hex[:6]}")
    seats = {r.publisher_name: r.publisher_seat for r in star.dim_publisher.collect()}
    assert seats == {"Editora P": "primeira"}


def test_one_writer_never_gets_more_than_a_bounded_file(spark):
    """Few rows go in one CSV file; more go in files of bounded size, all rows once."""
    import glob
    import uuid

    from starmart.plans.etl import csv_one_file
    from starmart.sources.warehouse import dataset_base

    raw = raw_frame(spark, [{"nome_autor": f"A{i}"} for i in range(50)])
    for rows_per_file, files in ((50, 1), (20, 3)):
        dataset = f"test-one-file-{uuid.uuid4().hex[:6]}"
        got = csv_one_file(spark, raw, dataset, rows_per_file=rows_per_file).collect()
        assert sorted(r["nome_autor"] for r in got) == sorted(f"A{i}" for i in range(50))
        assert {r["titulo_livro"] for r in got} == {'say "Livro",\n\n"two"\r\nthree'}
        written = glob.glob(f"{dataset_base(spark, dataset).removeprefix('file:')}/csv/*/csv/part-*")
        assert len(written) == files
        assert all(open(f, newline="").read().count("three") <= rows_per_file for f in written)


def test_text_on_disk_is_bounded_however_many_rows(spark, monkeypatch):
    """Rows of more files than a round holds go through CSV in rounds, all of them once."""
    import glob
    import uuid
    from collections import Counter

    from starmart.plans import etl
    from starmart.sources.warehouse import dataset_base

    dataset, write, held = f"test-rounds-{uuid.uuid4().hex[:6]}", etl.write_submissions_csv, []
    base = dataset_base(spark, dataset).removeprefix("file:")

    def text_rows():
        return sum(open(f, newline="").read().count("three") for f in glob.glob(f"{base}/**/*.csv", recursive=True))

    monkeypatch.setattr(etl, "write_submissions_csv", lambda *a, **k: (write(*a, **k), held.append(text_rows())))
    names = [None if i % 7 == 0 else f"A{i % 20}" for i in range(50)]  # nulls and repeated rows
    got = etl.csv_one_file(spark, raw_frame(spark, [{"nome_autor": a} for a in names]), dataset, rows_per_file=2)
    rows = got.collect()
    assert got.columns == list(etl.CLEAN_COLUMNS)
    assert Counter(r["nome_autor"] for r in rows) == Counter(names)
    assert {r["titulo_livro"] for r in rows} == {'say "Livro",\n\n"two"\r\nthree'}
    assert sum(held) == 50 and max(held) <= 2 * etl.FILES_PER_ROUND


def test_large_input_is_joined_in_parts(spark, monkeypatch, tmp_path):
    """Rows of much input are stored part by part, every row once, null and repeated keys too."""
    import uuid
    from collections import Counter

    from pyspark.sql import functions as F

    from starmart.plans import etl

    raw_frame(spark, [{"nome_autor": f"A{i % 30}"} for i in range(40)]).write.parquet(str(tmp_path / "raw rows"))
    key = F.struct(F.when(F.col("row_key.row_pos") > 4, F.col("row_key.row_pos") % 15).alias("row_pos"))
    raw = spark.read.parquet(str(tmp_path / "raw rows")).withColumn("row_key", key)
    write, held = etl.write_table, []
    monkeypatch.setattr(etl, "write_table", lambda df, path, **k: (held.append(df.count()), write(df, path, **k)))
    monkeypatch.setattr(etl, "PART_BYTES", 100)
    rows = etl.csv_one_file(spark, raw, f"test-parts-{uuid.uuid4().hex[:6]}").collect()
    assert Counter(r["nome_autor"] for r in rows) == Counter(f"A{i % 30}" for i in range(40))
    assert len(held) == etl.MOST_PARTS and sum(held) == 40 and max(held) < 30


def test_parts_reach_the_scans_of_lines_and_orders(spark, monkeypatch):
    from conftest import SF_SMALL
    from starmart.plans import etl
    from starmart.sources.staging import staging_submissions

    raw = staging_submissions(spark, SF_SMALL, broadcast_rows=0)
    whole = etl._parts(raw)
    monkeypatch.setattr(etl, "PART_BYTES", 100)
    parts = etl._parts(raw)
    assert len(whole) == 1 and len(parts) == etl.MOST_PARTS
    assert sum(p.count() for p in parts) == raw.count()
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(l_orderkey" in plan and "xxhash64(o_orderkey" in plan


def test_rounds_hold_every_file_once():
    from starmart.plans.etl import _rounds

    stored = [("c", 3), ("a", 4), ("b", 2), ("e", 9), ("d", 1)]
    assert _rounds(stored, 6) == [(["a", "b"], 6), (["c", "d"], 4), (["e"], 9)]
    assert _rounds([], 6) == []
