"""Stored dashboard marts: d01-d10 are computed once per warehouse run and
written next to the star, so every dashboard interaction reads a small table
instead of re-aggregating the fact.

The fact is scanned twice. Seven marts group only by time, author or publisher
attributes: they share a lattice of two grouping sets, (time_id, author_id) and
(time_id, publisher_id), which one Expand feeds to one aggregate. The three book
marts know a book by its genre and country alone: the fact is summed by these kinds
of books, each under the id of one book of its kind, so the marts' plans stay theirs.
"""

from __future__ import annotations

import dataclasses
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.measures import ALL_MEASURES, FLAG_OF, measures_by
from starmart.plans.reports import DASHBOARD
from starmart.sources.warehouse import Star, write_table

# Which pre-aggregate serves which mart.
_BY_AUTHOR = ("d03", "d06", "d07")
_BY_PUBLISHER = ("d01", "d08", "d09", "d10")
_BY_KIND = ("d02", "d04", "d05")
_KIND = ["book_genre", "first_edition_country"]


def fact_lattice(fact: DataFrame) -> DataFrame:
    """Measures by (time_id, author_id) and by (time_id, publisher_id), told apart by
    ``by``, in one pass. (No foreign key of the fact is null.)"""
    sets = [["time_id", "author_id"], ["time_id", "publisher_id"]]
    sums = [F.sum(c).cast("long").alias(m) for m, c in FLAG_OF.items()]
    out = fact.groupingSets(sets, "time_id", "author_id", "publisher_id").agg(F.count(F.lit(1)).alias("n"), *sums)
    return out.withColumn("by", F.when(F.col("author_id").isNotNull(), "author").otherwise("publisher"))


def book_kinds(dim_book: DataFrame) -> DataFrame:
    """One book per genre and country: the one with the least id."""
    return dim_book.groupBy(*_KIND).agg(F.min("book_id").alias("book_id"))


def by_book_kind(star: Star, kinds: DataFrame, rows: int | None) -> DataFrame:
    """Measures by time_id and kind, under the kind's ``book_id``."""
    same = F.lit(True)
    for c in _KIND:
        same = same & star.dim_book[c].eqNullSafe(kinds[c])
    few = F.broadcast(kinds) if rows is not None else kinds
    of_kind = star.dim_book.join(few, same).select(star.dim_book["book_id"], kinds["book_id"].alias("kind"))
    dims = [(of_kind, "book_id", star.broadcast_rows("dim_book"))]
    return measures_by(star.fact_submission, dims, ["time_id", "kind"], fact_keys=("time_id",)).withColumnRenamed("kind", "book_id")


def build_marts(spark: SparkSession, star: Star, concurrency: int = 4) -> dict[str, DataFrame]:
    """Write d01-d10 next to the star. Independent writes are submitted a few at
    a time, so small jobs share the cluster."""
    folder = f"{star.path}/marts"

    def stored(df, name, partition_by=None):
        write_table(df, f"{folder}/{name}", partition_by)
        return spark.read.parquet(f"{folder}/{name}")

    def lattice():
        return stored(fact_lattice(star.fact_submission), "_lattice", ["by"])

    def of_books():
        kinds = stored(book_kinds(star.dim_book), "_book_kinds")
        small = dataclasses.replace(star, dim_book=kinds, paths={"dim_book": f"{folder}/_book_kinds"})
        sums = stored(by_book_kind(star, kinds, small.broadcast_rows("dim_book")), "_by_kind")
        return dataclasses.replace(small, fact_submission=sums)

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        by_ids, by_kind = [f.result() for f in [pool.submit(lattice), pool.submit(of_books)]]
        sources = {name: by_kind for name in _BY_KIND}
        for by, names in (("author", _BY_AUTHOR), ("publisher", _BY_PUBLISHER)):
            part = by_ids.where(F.col("by") == by).select("time_id", f"{by}_id", *ALL_MEASURES)
            sources.update({name: dataclasses.replace(star, fact_submission=part) for name in names})

        def write(item):
            name, report = item
            write_table(report(sources[name]), f"{folder}/{name}")

        list(pool.map(write, DASHBOARD.items()))
    return read_marts(spark, star.path)


def read_marts(spark: SparkSession, run_path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{run_path}/marts/{name}") for name in DASHBOARD}


def live_marts(star: Star) -> dict[str, DataFrame]:
    """The d01-d10 reports as lazy plans over the star: views over these run live
    on the fact, and Catalyst pushes a view's year or genre filter below the
    aggregate into the dimension scan (and prunes fact partitions by time)."""
    return {name: report(star) for name, report in DASHBOARD.items()}
