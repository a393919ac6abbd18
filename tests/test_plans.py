"""Plan checks: no Python in any plan, pushdown and pruning reach the scans,
top-k plans as TakeOrderedAndProject, dedupes combine before the shuffle."""

from __future__ import annotations

import pytest

from starmart.plans import reports, views
from starmart.plans.star import dim_author_rows, dim_book_rows, dim_publisher_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted({**reports.REPORTS, **reports.DASHBOARD}))
def test_reports_stay_in_the_jvm(small_star, key):
    text = plan({**reports.REPORTS, **reports.DASHBOARD}[key](small_star))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert python_node not in text


def test_topk_plans_as_take_ordered(small_star):
    assert "TakeOrderedAndProject" in plan(reports.q10(small_star))
    assert "TakeOrderedAndProject" in plan(reports.d08(small_star))


def test_dimension_filter_pushed_to_scan(small_star):
    text = plan(reports.q03(small_star))
    assert "PushedFilters: [IsNotNull(author_gender), In(author_gender, [Feminino,Masculino])" in text or (
        "In(author_gender" in text
    )


def test_fact_scan_reads_only_needed_columns(small_star):
    text = plan(reports.q05(small_star))
    schemas = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line]
    fact_scans = [s for s in schemas if "is_winner" in s]
    assert fact_scans == ["struct<book_id:bigint,is_winner:int,is_finalist:int,is_semifinalist:int>"], schemas


def test_large_dimension_joins_after_preaggregation(small_star):
    from starmart.operators.measures import measures_by

    dim = small_star.dim_book.select("book_id", "book_genre")
    # Treated as larger than the broadcast bound: reduce the fact by book_id first.
    text = optimized(measures_by(small_star.fact_submission, [(dim, "book_id", 10**9)], ["book_genre"], ("n",)))
    join_at = text.find("Join Inner")
    assert join_at >= 0
    assert "Aggregate [book_id" in text[join_at:]
    assert "broadcast" not in text.lower()


def test_wide_dimension_stays_a_shuffle_join(spark, small_star, tmp_path):
    """Few but very wide rows are over the byte bound: no forced broadcast."""
    import dataclasses

    from pyspark.sql import functions as F

    from starmart.operators.lookup import BROADCAST_BYTES, null_safe_lookup, stored_bytes
    from starmart.sources.warehouse import write_table

    wide = small_star.dim_author.withColumn("author_gender", F.repeat(F.lit("x"), F.lit(BROADCAST_BYTES // 100)))
    path = f"{small_star.path}/../wide-{tmp_path.name}"
    write_table(wide, f"{path}/dim_author")
    stored = spark.read.parquet(f"{path}/dim_author")
    assert stored_bytes(spark, f"{path}/dim_author") > BROADCAST_BYTES
    star = dataclasses.replace(small_star, dim_author=stored, path=path)
    assert star.broadcast_rows("dim_author") is None
    assert "Broadcast" not in plan(reports.q07(star)).split("Scan parquet")[0] or "strategy=broadcast" not in optimized(reports.q07(star))
    lookup = null_safe_lookup(
        small_star.fact_submission.select("author_id"),
        stored,
        [("author_id", "author_id")],
        ["author_gender"],
        dim_rows=148,
        dim_bytes=stored_bytes(spark, f"{path}/dim_author"),
        hot=[],
    )
    assert "strategy=broadcast" not in optimized(lookup)


def test_numbered_rows_are_not_sorted_for_the_fact_and_sampling_runs_no_join(spark, small_star, monkeypatch):
    from starmart.datasets import load_testdata
    from starmart.operators import lookup
    from starmart.plans import star as star_plan

    from conftest import SF_SMALL

    sampled, ranked, written = [], [], {}
    monkeypatch.setattr(star_plan, "hot_keys", lambda df, cols, rows: sampled.append(optimized(df)) or lookup.hot_keys(df, cols, rows))
    plain, write = star_plan.with_dense_id, star_plan.write_table
    monkeypatch.setattr(star_plan, "with_dense_id", lambda df, *a, **k: ranked.append(a[1]) or plain(df, *a, **k))
    monkeypatch.setattr(star_plan, "write_table", lambda df, path, *a: written.__setitem__(path.rpartition("/")[2], plan(df)) or write(df, path, *a))
    load_testdata(spark, SF_SMALL, "test-narrow", broadcast_rows=0, rows_per_range=900)
    assert len(sampled) == 5 and not any("Join" in p for p in sampled)
    assert sorted(ranked) == ["author_id", "book_id", "publisher_id", "time_id"]
    assert "rangepartitioning" not in written["fact_submission"] and "titulo_livro" not in written["fact_submission"]
    # The rows are exchanged by (title, author) once, where books are chosen; the fact follows the row number.
    by_key = [n for n, p in written.items() if "hashpartitioning(titulo_livro" in p]
    assert by_key == ["by_book"] and written["by_book"].count("hashpartitioning(titulo_livro") == 1
    assert "Window" in written["by_book"] and "hashpartitioning(book_row" not in written["by_book"]


def test_dimensions_are_chosen_by_hash_aggregates(spark, small_star):
    clean = spark.read.parquet(f"{small_star.path}/clean")
    for rows in (dim_author_rows, dim_book_rows, dim_publisher_rows):
        text = plan(rows(clean))
        assert "SortAggregate" not in text and text.count("HashAggregate") == 2 and "partial_min" in text


def test_small_dimension_broadcast_into_fact_stream(small_star):
    text = plan(reports.q01(small_star))
    assert "BroadcastHashJoin" in text
    # One aggregation (partial + final) only: no pre-aggregation by time_id.
    assert text.count("HashAggregate(keys=[year") == 2


def test_dedupe_combines_before_shuffle(spark, small_star):
    clean = spark.read.parquet(f"{small_star.path}/clean")
    for df in (dim_author_rows(clean), dim_publisher_rows(clean)):
        text = plan(df)
        assert "partial_min" in text
        assert "Window" not in text


def test_marts_scan_the_fact_twice_and_equal_the_reports(spark, small_star, monkeypatch):
    import dataclasses
    import shutil

    from starmart.plans import marts
    from starmart.sources.warehouse import Star

    plain = marts.write_table
    for rows in (None, 0):  # books broadcast, and too many for it
        scans = []

        def write(df, path, *a):
            scans.extend(line for line in plan(df).splitlines() if "FileScan" in line and "is_winner" in line)
            plain(df, path, *a)

        monkeypatch.setattr(marts, "write_table", write)
        if rows == 0:
            sized = Star.broadcast_rows
            monkeypatch.setattr(Star, "broadcast_rows", lambda self, name: None if name == "dim_book" else sized(self, name))
        path = f"{small_star.path}-marts-{rows}"
        shutil.copytree(small_star.path.removeprefix("file:"), path.removeprefix("file:"), ignore=shutil.ignore_patterns("marts"))
        built = marts.build_marts(spark, dataclasses.replace(small_star, path=path))
        assert len(scans) == 2, scans
        for name, report in reports.DASHBOARD.items():
            expected = report(small_star)
            assert built[name].count() == expected.count() and built[name].exceptAll(expected).count() == 0, name


def test_year_filter_prunes_mart_partitions(spark, small_star):
    from starmart.datasets import testdata_marts

    from conftest import SF_SMALL

    marts = testdata_marts(spark, SF_SMALL)
    text = plan(views.v02(marts, (1996, 1997)))
    assert "PushedFilters" in text and "year" in text


def test_year_filter_on_time_dimension_prunes_fact_partitions(small_star):
    from pyspark.sql import functions as F

    years = small_star.dim_time.filter(F.col("year").between(1996, 1997)).select("time_id", "year")
    df = small_star.fact_submission.join(years, "time_id").groupBy("year").count()
    text = plan(df)
    assert "dynamicpruningexpression" in text.lower(), text
    assert sorted(r["count"] for r in df.collect()) == sorted(
        r["count"]
        for r in small_star.fact_submission.join(small_star.dim_time, "time_id")
        .filter(F.col("year").between(1996, 1997))
        .groupBy("year")
        .count()
        .collect()
    )


def test_live_view_pushes_year_filter_into_time_scan(small_star):
    from starmart.plans.marts import live_marts

    df = views.v02(live_marts(small_star), (1996, 1997))
    text = plan(df)
    time_scans = [line for line in text.splitlines() if "ReadSchema: struct<time_id:bigint,year:int" in line]
    assert time_scans and all("GreaterThanOrEqual(year,1996)" in line for line in time_scans), text
    assert sorted(r.year for r in df.collect()) == [1996, 1997]


def test_ranged_ids_never_number_rows_in_one_partition(spark, small_star):
    from starmart.operators.dense_ids import with_dense_id
    from starmart.sources.warehouse import shared_root

    clean = spark.read.parquet(f"{small_star.path}/clean").select("row_key", "nome_autor")
    ids = with_dense_id(clean, ["row_key"], "submission_id", workdir=f"{shared_root(spark)}/test-plan-ids", rows_per_range=1000)
    text = plan(ids)
    assert "row_number" not in text  # no numbering window over the rows
    assert "BroadcastHashJoin" in text  # offsets, one row per range, joined map-side
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "__range" in windows[0]  # the running offsets over per-range counts
