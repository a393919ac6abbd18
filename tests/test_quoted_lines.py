"""CSV records whose cells hold line breaks, read in splits: against Spark's reader of whole files."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import RAW_DEFAULTS, raw_frame
from pyspark.sql import functions as F

from starmart.sources.csv import read_submissions_csv, write_submissions_csv
from starmart.sources.quoted_lines import Lines, chain, csv_records, end_state
from starmart.sources.schemas import RAW_COLUMNS

SIZES = (40, 130, 1000, 1 << 27)


@pytest.fixture
def split_size(spark):
    """Set the size that files are split to."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def put(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield put
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)


def messy_file(r: random.Random, clean: bool, end: str) -> str:
    """A header, then rows of quoted cells with line breaks, commas and doubled quotes; unless
    ``clean`` also stray quotes in bare cells and text after a closing quote."""
    out = ["c0,c1,c2" + end]
    for _ in range(30):
        cells = []
        for _ in range(3):
            if r.random() < 0.5:
                body = "".join(r.choice(["a", "b", ",", '""', "\n", "é", "\r\n", " ", "x" * 7]) for _ in range(r.randint(0, 6)))
                cells.append(f'"{body}"')
            elif not clean and r.random() < 0.2:
                cells.append('"' + "".join(r.choices("ab c", k=3)) + '"z')
            else:
                bare = "".join(r.choices("abc " if clean else 'abc "', k=r.randint(1, 5)))
                cells.append("q" + bare)
        out.append(",".join(cells) + end)
        if r.random() < 0.1:
            out.append(end)
    text = "".join(out)
    return text if r.random() < 0.5 else text[: -len(end)]


OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@pytest.mark.parametrize(("seed", "clean", "end"), [(1, True, "\n"), (2, False, "\n"), (3, False, "\n"), (4, True, "\r\n"), (5, False, "\r\n")])
def test_records_are_those_of_the_unsplit_reader(spark, tmp_path, split_size, seed, clean, end):
    r = random.Random(seed)
    for name in ("p0", "p1"):
        (tmp_path / f"{name}.csv").write_bytes(messy_file(r, clean, end).encode())
    kind = "c0 string, c1 string, c2 string"
    whole = spark.read.schema(kind).options(header=True, columnPruning=False, **OPTIONS).csv(str(tmp_path))
    whole = whole.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("k"))
    expected = [tuple(x)[:3] for x in whole.orderBy("file", "k").collect()]
    for size in SIZES:
        split_size(size)
        records, splits = csv_records(spark, str(tmp_path))
        assert (splits > 20) == (size < 100)
        parsed = records.where("NOT header").select("number", F.from_csv("record", kind, {**OPTIONS, "lineSep": "\n"}).alias("c"))
        parsed = parsed.orderBy("number").collect()
        assert [x["number"] for x in parsed] == list(range(len(parsed)))
        got = [tuple(x["c"]) for x in parsed]
        if end != "\n":
            # The unsplit reader turns line breaks within cells of such files into line feeds; here they stay.
            assert any("\r\n" in (v or "") for x in got for v in x)
            got = [tuple(v and v.replace("\r\n", "\n") for v in x) for x in got]
        assert got == expected


def test_row_keys_follow_the_file_whatever_the_splits(spark, tmp_path, split_size):
    rows = [{"titulo_livro": f"{i}\n" * (i % 5 + 1) + ("x" * 300 if i % 17 == 0 else ""), "nome_autor": f'"{i}",'} for i in range(200)]
    write_submissions_csv(raw_frame(spark, rows).repartition(1).orderBy("row_key").coalesce(1), str(tmp_path / "csv"))
    found = []
    for size in SIZES:
        split_size(size)
        back = read_submissions_csv(spark, str(tmp_path / "csv"))
        found.append([(r["titulo_livro"], r["nome_autor"], r["ano"]) for r in back.orderBy("row_key").collect()])
        assert sorted(r["row_key"] for r in back.collect()) == list(range(200))
    assert found[0] == [(r["titulo_livro"], r["nome_autor"], 2015) for r in rows]
    assert all(f == found[0] for f in found)


def test_one_file_is_read_by_many_tasks_and_only_crossing_records_are_shuffled(spark, tmp_path, split_size):
    rows = [{"titulo_livro": f"{i}" + "\nand a line more" * (i % 9)} for i in range(400)]
    write_submissions_csv(raw_frame(spark, rows).repartition(1), str(tmp_path / "csv"))
    split_size(2000)
    records, splits = csv_records(spark, str(tmp_path / "csv"))
    # The records within splits go on as they are; those that cross meet in the one shuffle.
    plan = records._jdf.queryExecution().executedPlan().toString()
    shuffles = plan.count("Exchange ") - plan.count("BroadcastExchange ")
    assert shuffles == plan.count("Exchange hashpartitioning(") == 1 and "Sort" not in plan and "Window" not in plan
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert splits > 20 and tasks > 20 and records.count() == 401
    assert read_submissions_csv(spark, str(tmp_path / "csv")).count() == 400


def test_header_over_several_lines_and_splits(spark, tmp_path, split_size):
    names = [*RAW_COLUMNS, "extra\n" + "long " * 30]
    header = ",".join(f'"{n}"' for n in names)
    line = ",".join([*(str(RAW_DEFAULTS[c]) for c in RAW_COLUMNS), "x"])
    for i in range(3):
        (tmp_path / f"p{i}.csv").write_text("\n" * i + header + "\n" + "\n".join([line] * i))
    for size in SIZES:
        split_size(size)
        back = read_submissions_csv(spark, str(tmp_path))
        assert [r["titulo_livro"] for r in back.collect()] == ["Livro"] * 3
    (tmp_path / "p3.csv").write_text(header.replace("extra", "other") + "\n" + line + "\n")
    for size in SIZES:
        split_size(size)
        with pytest.raises(Exception, match="another header"):
            read_submissions_csv(spark, str(tmp_path)).collect()


def test_wrong_cell_count_fails_in_any_split(spark, tmp_path, split_size):
    line = ",".join(str(RAW_DEFAULTS[c]) for c in RAW_COLUMNS)
    (tmp_path / "p.csv").write_text("\n".join([",".join(RAW_COLUMNS), *[line] * 30, line + ",more", *[line] * 30]))
    for size in (300, 1 << 27):
        split_size(size)
        with pytest.raises(Exception, match="MALFORMED"):
            read_submissions_csv(spark, str(tmp_path)).collect()


def test_carriage_returns_alone_are_read_unsplit(spark, tmp_path):
    line = ",".join(str(RAW_DEFAULTS[c]) for c in RAW_COLUMNS)
    (tmp_path / "p.csv").write_bytes("\r".join([",".join(RAW_COLUMNS), line, line]).encode())
    assert read_submissions_csv(spark, str(tmp_path)).count() == 2


def test_files_of_a_header_alone_have_no_rows(spark, tmp_path, split_size):
    (tmp_path / "p.csv").write_text(",".join(RAW_COLUMNS))
    for size in SIZES:
        split_size(size)
        assert read_submissions_csv(spark, str(tmp_path)).count() == 0


def test_other_splits_than_scanned_are_an_error(spark, tmp_path, split_size):
    write_submissions_csv(raw_frame(spark, [{"titulo_livro": "a\nb"}] * 50).repartition(1), str(tmp_path / "csv"))
    split_size(900)
    back = read_submissions_csv(spark, str(tmp_path / "csv"))
    split_size(700)
    with pytest.raises(Exception, match="split anew"):
        back.collect()


def test_line_states_fold_like_a_loop():
    r = random.Random(6)
    for n in (0, 1, 2, 40):
        for kind in ("abc", 'a,"', 'a,"",""', '"a","b""c"\r,', '"'):
            for _ in range(25):
                # Also lines that begin within a larger array.
                text = ["".join(r.choice(kind) for _ in range(r.randint(0, 9))) for _ in range(n + 2)]
                lines = Lines(pa.array(text, pa.string()).slice(1, n))
                text = text[1 : n + 1]
                loops = {}
                for state in (False, True):
                    states = [state]
                    for line in text:
                        states.append(end_state(line.encode(), states[-1]))
                    assert lines.states(state).tolist() == states
                    loops[state] = states
                assert lines.states_until(True, np.array(loops[False])).tolist() == loops[True]
                assert lines.blank.tolist() == [t in ("", "\r") for t in text]


def test_end_state_follows_cells():
    cases = [("", 0, 1), ("a,b", 0, 1), ('"a', 1, 0), ('"a"', 0, 0), ('a"', 0, 0), ('"a""', 1, 0), ('"a"b,"c', 1, 1), ('x,"', 1, 0), ('",x', 1, 0), ('"","', 1, 0), ('""', 0, 1), ('"""', 1, 0), (' "a', 0, 0)]
    for line, outside, inside in cases:
        assert (end_state(line.encode(), False), end_state(line.encode(), True)) == (bool(outside), bool(inside)), line


def test_chain_names_the_split_a_record_opened_in():
    row = lambda start, **k: {"file_path": "f", "block_start": start, "split": start + 1, "n0": 0, "n1": 0} | {f"{x}{s}": None for x in ("start", "tail") for s in (0, 1)} | {"end0": False, "end1": True} | k
    splits, crossing = chain([row(200, start1=25, n1=4), row(0, end0=True, tail0=7, n0=3), row(100), row(300, end1=False, start1=31, n1=2), row(7, file_path="e", n0=5)])
    # The record opened at place 7, the second after the header, runs through the next two splits into the last.
    assert splits.keys.tolist() == [1, 8, 101, 201, 301] and splits.inside.tolist() == [False, False, True, True, True]
    assert splits.number.tolist() == [3, -1, 6, 6, 10] and splits.header.tolist() == [True, True, False, False, False]
    assert crossing == [
        (1, 0, False, None, None, 7, 5, False),
        (101, 100, True, None, 1, None, 5, False),
        (201, 200, True, 25, 1, None, 9, False),
        (301, 300, True, 31, 1, None, 11, False),
    ]
    assert splits.find(101) == 2
    with pytest.raises(RuntimeError, match="split anew"):
        splits.find(2)
