"""Hot keys: a third of all rows on one key must not change results, and the
shuffle path must route hot keys around the shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmart.operators.lookup import hot_keys, null_safe_lookup
from starmart.params import TESTDATA_YEARS
from starmart.plans.star import build_star
from starmart.sources.staging import staging_submissions

from conftest import SF_SMALL


def _skewed_facts(spark, n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:
            name = "HOT"
        elif i % 50 == 1:
            name = None
        else:
            name = f"a{i % 97}"
        rows.append((i, name))
    return spark.createDataFrame(rows, "rid long, name string")


def _dim(spark, facts):
    names = facts.select("name").distinct()
    return names.select(F.col("name").alias("author_name"), F.xxhash64("name").alias("author_id"))


def test_hot_keys_found_and_bounded(spark):
    facts = _skewed_facts(spark)
    hot = hot_keys(facts, ["name"], facts.count(), share=0.01)
    assert ("HOT",) in hot and (None,) in hot
    assert len(hot) <= 100


def test_shuffle_lookup_with_hot_keys_equals_broadcast(spark):
    facts = _skewed_facts(spark)
    dim = _dim(spark, facts)
    on = [("name", "author_name")]
    fast = null_safe_lookup(facts, dim, on, ["author_id"], max_broadcast_rows=10**9)
    split = null_safe_lookup(facts, dim, on, ["author_id"], max_broadcast_rows=0, hot_share=0.01)
    assert split.columns == fast.columns
    a = {r.rid: r.author_id for r in fast.collect()}
    b = {r.rid: r.author_id for r in split.collect()}
    assert a == b and len(b) == 3000 and None not in b.values()
    text = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text  # hot keys, map-side
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text  # the rest


def test_hot_rows_spread_over_shuffle_partitions(spark):
    facts = _skewed_facts(spark)
    dim = _dim(spark, facts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = null_safe_lookup(facts, dim, [("name", "author_name")], ["author_id"], max_broadcast_rows=0, hot_share=0.01)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The hot key alone is a third of the rows; no partition may hold it whole.
    assert max(sizes) < 1000, sizes


def test_star_with_all_shuffle_lookups_matches_default(spark, small_star):
    raw = staging_submissions(spark, SF_SMALL)
    forced = build_star(spark, raw, TESTDATA_YEARS, dataset=f"test-forced-{uuid.uuid4().hex[:6]}", broadcast_rows=0)
    cols = ["submission_id", "time_id", "author_id", "book_id", "publisher_id"]
    a = small_star.fact_submission.select(*cols)
    b = forced.fact_submission.select(*cols)
    assert a.count() == b.count() == 6000
    assert a.exceptAll(b).count() == 0


def test_shuffle_lookup_with_differing_key_types(spark):
    # Key 7 holds half the rows (hot); keys 0..49 are cold and go through the shuffle.
    data = [(i, 7 if i % 2 else (i // 2) % 50) for i in range(400)]
    facts = spark.createDataFrame(data, "rid long, k int")
    dim = spark.createDataFrame([(k, k * 10) for k in range(50)], "key long, val long")
    assert hot_keys(facts, ["k"], 400, share=0.1) == [(7,)]
    out = null_safe_lookup(facts, dim, [("k", "key")], ["val"], max_broadcast_rows=0, hot_share=0.1)
    got = {r.rid: r.val for r in out.collect()}
    assert got == {rid: k * 10 for rid, k in data}
