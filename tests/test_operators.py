"""Small operators: spread, stored row counts, dedupe order."""

from __future__ import annotations

import random
import tempfile

from pyspark.sql import functions as F

from starmart.operators.dedupe import keep_first, keep_latest
from starmart.operators.lookup import stored_rows
from starmart.operators.spread import scan_splits, spread
from starmart.session import default_parallelism


def test_spread_only_narrow_inputs(spark):
    target = default_parallelism(spark)
    one = spark.range(0, 1000, numPartitions=1)
    spread_one = spread(one, splits=1)
    assert spread_one.rdd.getNumPartitions() == target
    assert sorted(r.id for r in spread_one.collect()) == list(range(1000))
    wide = spark.range(0, 1000, numPartitions=target * 2)
    assert spread(wide, splits=target * 2) is wide and spread(wide, splits=target // 2 + 1) is wide


def test_stored_rows_reads_and_memoises(spark):
    path = tempfile.mkdtemp(prefix="starmart-rows-") + "/t"
    spark.range(123).write.parquet(path)
    assert stored_rows(spark, path) == 123
    assert stored_rows(spark, path) == 123
    spark.range(77).write.mode("overwrite").parquet(path)
    assert stored_rows(spark, path) == 77  # another table now


def test_scan_splits_counts_the_tasks_that_read_rows(spark, tmp_path):
    spark.range(0, 100, numPartitions=3).write.parquet(str(tmp_path / "t"))
    assert 1 <= scan_splits(spark.read.parquet(str(tmp_path / "t"))) <= 3


def test_keep_first_and_latest_pick_by_order(spark):
    df = spark.createDataFrame(
        [("a", 2020, 3, "x"), ("a", 2020, 1, "y"), ("a", 2019, 0, "z"), (None, 2018, 5, "n1"), (None, 2018, 4, "n2")],
        "k string, year int, rk long, v string",
    )
    first = {r.k: r.v for r in keep_first(df, ["k"], [F.col("rk")], ["v"]).collect()}
    assert first == {"a": "z", None: "n2"}
    latest = {r.k: r.v for r in keep_latest(df, ["k"], "year", "rk", ["v"]).collect()}
    assert latest == {"a": "y", None: "n2"}


def test_chosen_rows_are_the_first_or_the_latest(spark):
    from starmart.operators.dedupe import chosen_rows, take_rows

    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", None, ""]), r.choice([None, 0, -5, 2015, 2024, 2**31 - 1, -(2**31)]), f"v{i}") for i in range(300)]
    rows += [(10**18 + i, "far", 2000 + i % 2, f"f{i}") for i in range(4)]
    df = spark.createDataFrame(rows, "n long, k string, year int, v string").repartition(4)
    first, latest = {}, {}
    for n, k, year, v in sorted(rows, key=lambda x: x[0]):
        first.setdefault(k, v)
        known = -(2**40) if year is None else year
        if k not in latest or known > latest[k][0]:
            latest[k] = (known, v)
    assert {x["k"]: x["v"] for x in take_rows(df, "n", chosen_rows(df, ["k"], "n"), ["k", "v"]).collect()} == first
    got = take_rows(df, "n", chosen_rows(df, ["k"], "n", "year"), ["k", "v"]).collect()
    assert {x["k"]: x["v"] for x in got} == {k: v for k, (_, v) in latest.items()} and len(got) == 5
