
from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from starmart.params import PRIZE_YEARS
from starmart.plans.star import build_star

from conftest import raw_frame


@pytest.fixture(scope="module")
def edge_star(spark):
    rows = [
        {"ano": 2016, "nome_autor": "Ana", "genero_autor": "Masculino"},
        {"ano": 2019, "nome_autor": "Ana", "genero_autor": "Feminino", "titulo_livro": "B"},
        {"ano": 2020, "nome_autor": "Caio", "faixa_etaria_autor": "de 20 a 30 anos"},
        {"ano": 2020, "nome_autor": "Caio", "faixa_etaria_autor": "de 50 a 60 anos", "titulo_livro": "C"},
        {"ano": 2021, "nome_autor": None, "titulo_livro": "D"},
        {"ano": 2022, "nome_autor": None, "titulo_livro": "D", "indicador_vencedor": "SIM"},
        {"ano": 2023, "nome_editora": "Autopublicação"},
        {"ano": 2024, "nome_editora": "AUTOPUBLICAÇÃO", "nome_autor": "  Ana ", "genero_autor": "Prefiro não informar"},
    ]
    return build_star(spark, raw_frame(spark, rows), PRIZE_YEARS, dataset=f"test-edge-{uuid.uuid4().hex[:6]}")


def test_author_latest_year_wins(edge_star):
    ana = edge_star.dim_author.filter(F.col("author_name") == "Ana").collect()
    # Rows from 2016, 2019 and 2024 (padded name): the 2024 row holds.
    assert len(ana) == 1 and ana[0].author_gender == "Prefiro não informar"


def test_author_tie_in_year_first_raw_row(edge_star):
    caio = edge_star.dim_author.filter(F.col("author_name") == "Caio").first()
    assert caio.author_age_band == "de 20 a 30 anos"


def test_null_author_single_row_and_keyed(edge_star):
    nulls = edge_star.dim_author.filter(F.col("author_name").isNull()).collect()
    assert len(nulls) == 1
    keyed = edge_star.fact_submission.filter(F.col("author_id") == nulls[0].author_id).count()
    assert keyed == 2
    books = edge_star.dim_book.filter(F.col("author_name").isNull()).collect()
    assert len(books) == 1 and books[0].title == "D"


def test_publisher_case_sensitive_same_type(edge_star):
    pubs = {r.publisher_name: r.publication_type for r in edge_star.dim_publisher.collect()}
    assert pubs["Autopublicação"] == pubs["AUTOPUBLICAÇÃO"] == "Autopublicação"
    assert pubs["Editora A"] == "Editora Tradicional"


def test_time_dimension(edge_star):
    rows = edge_star.dim_time.orderBy("year").collect()
    assert [r.time_id for r in rows] == list(range(1, len(rows) + 1))
    assert [r.year for r in rows] == [2016, 2019, 2020, 2021, 2022, 2023, 2024]
    by_year = {r.year: (r.decade, r.period) for r in rows}
    assert by_year[2019] == ("2010s", "Crescimento (2019-2021)")
    assert by_year[2022] == ("2020s", "Consolidação (2022-2024)")


def _assert_dense(df, col):
    agg = df.agg(F.min(col), F.max(col), F.countDistinct(col), F.count(F.lit(1))).first()
    assert agg[0] == 1 and agg[1] == agg[2] == agg[3]


@pytest.mark.parametrize(
    "table,id_col",
    [
        ("dim_time", "time_id"),
        ("dim_author", "author_id"),
        ("dim_book", "book_id"),
        ("dim_publisher", "publisher_id"),
        ("fact_submission", "submission_id"),
    ],
)
def test_ids_dense_unique(small_star, edge_star, table, id_col):
    for star in (small_star, edge_star):
        _assert_dense(star.tables()[table], id_col)


def test_fact_keeps_every_row_and_no_null_keys(spark, small_star):
    raw_rows = spark.read.parquet(f"{small_star.path}/clean").count()
    fact = small_star.fact_submission
    assert fact.count() == raw_rows == 6000
    nulls = fact.filter(
        F.col("time_id").isNull() | F.col("author_id").isNull() | F.col("book_id").isNull() | F.col("publisher_id").isNull()
    ).count()
    assert nulls == 0


def test_level_counts_add_up(spark, small_star):
    from starmart.plans.etl import clean_rows, level_counts

    counts = level_counts(clean_rows(spark, small_star)).collect()
    assert sum(r["count"] for r in counts) == 6000
    assert [r["count"] for r in counts] == sorted((r["count"] for r in counts), reverse=True)


def test_dimension_sizes_match_fixture_notes(small_star):
    # FIXTURES.md section 4: 148 authors (incl. null), 3,969 books, 11 publishers at sf0.001.
    assert small_star.dim_author.count() == 148
    assert small_star.dim_book.count() == 3969
    assert small_star.dim_publisher.count() == 11


def test_multi_range_ids_equal_single_range(spark, small_star):
    from pyspark.sql import Window

    from starmart.operators.dense_ids import with_dense_id
    from starmart.sources.warehouse import shared_root

    books = small_star.dim_book.select("title", "author_name")
    got = with_dense_id(books, ["title", "author_name"], "id", workdir=f"{shared_root(spark)}/test-ids", rows_per_range=257)
    exp = books.withColumn(
        "exp", F.row_number().over(Window.orderBy(F.col("title").asc_nulls_last(), F.col("author_name").asc_nulls_last()))
    )
    joined = got.join(exp, [got.title.eqNullSafe(exp.title), got.author_name.eqNullSafe(exp.author_name)])
    assert joined.count() == 3969
    assert joined.filter(F.col("id") != F.col("exp")).count() == 0


def test_refresh_publishes_last_complete_run(spark):
    from starmart.sources.warehouse import current_run, open_star

    dataset = f"test-refresh-{uuid.uuid4().hex[:6]}"
    first = build_star(spark, raw_frame(spark, [{}]), PRIZE_YEARS, dataset=dataset)
    assert current_run(spark, dataset) == first.path
    second = build_star(spark, raw_frame(spark, [{}, {"nome_autor": "Beto"}]), PRIZE_YEARS, dataset=dataset)
    assert current_run(spark, dataset) == second.path != first.path
    assert open_star(spark, dataset).fact_submission.count() == 2
    assert first.fact_submission.count() == 1  # the earlier run stays readable


def test_publishers_at_once_give_ordered_records_whatever_the_clock(spark, monkeypatch):
    import threading

    from starmart.sources import warehouse

    dataset = f"test-publish-{uuid.uuid4().hex[:6]}"
    runs = [f"run-{i}" for i in range(8)]
    gate, numbers = threading.Barrier(len(runs)), {}

    def go(run):
        gate.wait()
        numbers[run] = warehouse.publish(spark, dataset, run)

    threads = [threading.Thread(target=go, args=(run,)) for run in runs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(numbers.values()) == list(range(1, 9))
    assert [r["run"] for r in warehouse._published(spark, dataset)] == sorted(runs, key=lambda r: -numbers[r])
    # A clock that is set back changes nothing; a record that is not whole yet is not read.
    monkeypatch.setattr(warehouse.time, "time_ns", lambda: 0)
    assert warehouse.publish(spark, dataset, "later") == 9 and warehouse.current_run(spark, dataset) == "later"
    folder = f"{warehouse.dataset_base(spark, dataset)}/PUBLISHED"
    assert warehouse._create_once(spark, f"{folder}/{10:012d}.json", "") and not warehouse._create_once(spark, f"{folder}/{10:012d}.json", "x")
    assert warehouse.current_run(spark, dataset) == "later"
    assert warehouse.publish(spark, dataset, "last") == 11 and warehouse.current_run(spark, dataset) == "last"


def test_records_of_earlier_versions_are_older(spark):
    from starmart.sources import warehouse

    dataset = f"test-records-{uuid.uuid4().hex[:6]}"
    folder = f"{warehouse.dataset_base(spark, dataset)}/PUBLISHED"
    for stamp, run in ((5, "b"), (9, "c"), (2, "a")):
        spark.createDataFrame([(stamp, run)], "published_ns long, run string").coalesce(1).write.mode("append").json(folder)
    assert warehouse.current_run(spark, dataset) == "c"
    warehouse.publish(spark, dataset, "d")
    assert [r["run"] for r in warehouse._published(spark, dataset)] == ["d", "c", "b", "a"]


def test_old_runs_are_dropped_on_request_only(spark):
    from starmart.sources.warehouse import current_run, drop_old_runs

    dataset = f"test-old-{uuid.uuid4().hex[:6]}"
    runs = [build_star(spark, raw_frame(spark, [{}]), PRIZE_YEARS, dataset=dataset).path for _ in range(3)]
    assert drop_old_runs(spark, dataset, keep=2) == runs[:1]
    assert current_run(spark, dataset) == runs[2]
    assert spark.read.parquet(f"{runs[1]}/fact_submission").count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{runs[0]}/fact_submission")


def test_view_order_does_not_hang_on_the_stored_files(spark, small_star):
    from starmart.datasets import testdata_marts
    from starmart.plans import views

    from conftest import SF_SMALL

    marts = testdata_marts(spark, SF_SMALL)
    shuffled = {name: df.repartition(5) for name, df in marts.items()}
    unknown = spark.createDataFrame([("x", 1, 0), ("y", 3, 0), ("z", 3, 0), ("de 20 a 30 anos", 2, 0)], "faixa string, inscritos long, vencedores long")
    shuffled["d07"] = unknown.repartition(3)
    long = [(r["stage"], -r["works"], r["book_genre"]) for r in views.v04(shuffled).collect()]
    stages = [s for i, (s, _, _) in enumerate(long) if not i or long[i - 1][0] != s]
    assert stages == ["Inscritos", "Semifinalistas", "Finalistas", "Vencedores"]
    first = [x for x in long if x[0] == "Inscritos"]
    assert first == sorted(first)
    assert [g for s, _, g in long if s == "Vencedores"] == [g for _, _, g in first]
    assert [r["inscritos"] for r in views.v07(shuffled).collect()] == [2, 3, 3, 1]
    won = [(-r["Vitórias"], r["Editora"]) for r in views.v10(shuffled).collect()]
    assert won == sorted(won)


def test_large_scale_path_gives_identical_star(spark, small_star):
    """rows_per_range far below the data size takes every at-scale branch:
    materialised dedupes, multi-range ids for dimensions and fact, rebalanced
    fact write. Every table, ids included, must equal the default build."""
    import glob

    from starmart.datasets import load_testdata

    from conftest import SF_SMALL

    big = load_testdata(spark, SF_SMALL, f"test-big-{uuid.uuid4().hex[:6]}", rows_per_range=700)
    for name, df in small_star.tables().items():
        other = big.tables()[name]
        assert df.count() == other.count()
        assert df.exceptAll(other.select(*df.columns)).count() == 0, name
    per_year = {}
    for f in glob.glob(f"{big.path}/fact_submission/time_id=*/*.parquet"):
        year = f.split("time_id=")[1].split("/")[0]
        per_year[year] = per_year.get(year, 0) + 1
    assert per_year and max(per_year.values()) <= 2, per_year


def test_sources_without_row_numbers_give_the_same_star(spark, small_star):
    from starmart.params import TESTDATA_YEARS
    from starmart.sources.staging import staging_submissions

    from conftest import SF_SMALL

    raw = staging_submissions(spark, SF_SMALL)
    for rows_per_range in (700, 10**6):
        other = build_star(spark, raw, TESTDATA_YEARS, dataset=f"test-key-{uuid.uuid4().hex[:6]}", rows_per_range=rows_per_range)
        for name, df in small_star.tables().items():
            assert df.exceptAll(other.tables()[name].select(*df.columns)).count() == 0, name


def test_row_numbers_must_be_dense(spark):
    raw = raw_frame(spark, [{}, {}, {}]).withColumn("row_key", F.col("row_key.row_pos") * 2)
    with pytest.raises(ValueError, match="row numbers"):
        build_star(spark, raw, PRIZE_YEARS, dataset=f"test-gaps-{uuid.uuid4().hex[:6]}")


def test_hot_and_missing_books_find_their_row_without_a_hot_window(spark):
    """A third of all rows on one book, many on the book without title and author."""
    from starmart.operators.clean import clean_submissions
    from starmart.operators.lookup import hot_keys
    from starmart.plans.star import rows_with_book

    rows = []
    for i in range(900):
        hot = {"titulo_livro": "H", "nome_autor": "A"} if i % 3 == 0 else {"titulo_livro": None, "nome_autor": None} if i % 5 == 0 else {}
        rows.append({"titulo_livro": f"T{i % 400}", "nome_autor": f"A{i % 7}" if i % 11 else None, "genero_livro": f"g{i}"} | hot)
    raw = raw_frame(spark, rows).withColumn("row_key", F.col("row_key.row_pos"))
    clean = clean_submissions(raw).repartition(5)
    hot = hot_keys(clean, ["titulo_livro", "nome_autor"], 900, share=0.05)
    assert sorted(hot, key=str) == [("H", "A"), (None, None)]
    first = {}
    for i, r in enumerate(rows):
        first.setdefault((r["titulo_livro"], r["nome_autor"]), i)
    for keys in (hot, [], [*hot, ("absent", None)]):
        got = {r["row_key"]: r for r in rows_with_book(clean, keys).collect()}
        assert len(got) == 900
        for i, r in enumerate(rows):
            key = (r["titulo_livro"], r["nome_autor"])
            assert got[i]["book_row"] == first[key]
            expected = (*key, f"g{i}", "Brasil") if first[key] == i else None
            assert (got[i]["book"] and tuple(got[i]["book"])) == expected


def test_fact_check_rejects_missing_keys_and_rows(spark):
    from starmart.plans.star import check_fact

    good = spark.createDataFrame([(1, 1, 1, 1), (2, 1, 2, 1)], "time_id long, author_id long, book_id long, publisher_id long")
    check_fact(good, 2)
    with pytest.raises(RuntimeError, match="book_id: 1 null"):
        check_fact(spark.createDataFrame([(1, 1, None, 1)], good.schema), 1)
    with pytest.raises(RuntimeError, match="2 fact rows for 3"):
        check_fact(good, 3)


def test_numbering_stores_what_is_kept_and_books_are_not_copied(spark, monkeypatch):
    """The lines' copy under their numbers holds no column that only orders them, and books
    that were chosen in the stored exchange are numbered from it."""
    from starmart.datasets import load_testdata
    from starmart.operators.dense_ids import with_dense_id
    from starmart.plans import star as star_plan
    from starmart.sources import staging
    from starmart.sources.warehouse import shared_root

    from conftest import SF_SMALL

    rows = spark.createDataFrame([(i, 1000 - i, i % 3) for i in range(1000)], "a int, b int, c int")
    for rows_per_range in (100, 10**6):
        got = with_dense_id(rows, ["b"], "id", workdir=f"{shared_root(spark)}/test-keep", rows_per_range=rows_per_range, keep=["a", "c"])
        assert got.columns == ["a", "c", "id"]
        assert all(r["id"] == 1000 - r["a"] for r in got.collect())

    wide, written = [], []
    number, write = staging.with_dense_id, star_plan.write_table
    monkeypatch.setattr(staging, "with_dense_id", lambda *a, **k: wide.append((out := number(*a, **k)).columns) or out)
    monkeypatch.setattr(star_plan, "write_table", lambda df, path, *a: written.append(path.rpartition("/")[2]) or write(df, path, *a))
    load_testdata(spark, SF_SMALL, f"test-keep-{uuid.uuid4().hex[:6]}", broadcast_rows=0, rows_per_range=900)
    assert wide == [["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "hits", "line_number"]]
    assert written.count("dim_book") == 1 and written.count("by_book") == 1
