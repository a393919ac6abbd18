"""ETL: raw submissions -> cleaned table -> four dimensions + fact, as a warehouse run.

Every stage is written to the run folder and read back before the next one, so
lineage stays short, a lost executor only recomputes from the last written
table, and later stages read just the columns they need.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.derive import decade, period
from starmart.operators.clean import clean_submissions
from starmart.operators.dedupe import chosen_rows, keep_first, keep_latest, take_rows
from starmart.operators.dense_ids import DEFAULT_ROWS_PER_RANGE, MIN_ROWS_PER_RANGE, with_dense_id
from starmart.operators.lookup import (
    BROADCAST_BYTES,
    DEFAULT_BROADCAST_ROWS,
    broadcast_if_within,
    hot_keys,
    null_safe_lookup,
    stored_bytes,
    stored_rows,
)
from starmart.params import TimeBuckets
from starmart.sources.schemas import (
    DIM_AUTHOR_COLUMNS,
    DIM_BOOK_COLUMNS,
    DIM_PUBLISHER_COLUMNS,
    FACT_COLUMNS,
    ROW_KEY,
)
from starmart.sources.warehouse import Star, drop_folder, new_run, publish, read_star, write_table


@contextmanager
def _step(timings: dict | None, name: str):
    t0 = time.perf_counter()
    yield
    if timings is not None:
        timings[name] = round(time.perf_counter() - t0, 3)


def _materialize(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    write_table(df, path, partition_by)
    return spark.read.parquet(path)


def dim_time_rows(clean: DataFrame, buckets: TimeBuckets) -> DataFrame:
    """Distinct years with decade and period (ids added later)."""
    years = clean.select(F.col("ano").alias("year")).distinct()
    return years.select("year", decade("year", buckets).alias("decade"), period("year", buckets).alias("period"))


def is_numbered(rows: DataFrame) -> bool:
    """Whether the row key is the row's number, not just something that orders rows."""
    return isinstance(rows.schema[ROW_KEY].dataType, T.LongType)


def _picked(clean: DataFrame, keys: list[str], values: list[str], year: str | None, store) -> DataFrame:
    """One row per ``keys``: the first, or the first of the latest year. ``store`` writes
    the numbers of the chosen rows at scale, so that their count decides how they are met."""
    if not is_numbered(clean):
        if year:
            return keep_latest(clean, keys, year, ROW_KEY, values)
        return keep_first(clean, keys, [F.col(ROW_KEY)], values)
    chosen = chosen_rows(clean, keys, ROW_KEY, year)
    return take_rows(clean, ROW_KEY, store(chosen) if store else chosen, [*keys, *values])


def dim_author_rows(clean: DataFrame, store=None) -> DataFrame:
    """One row per author name (null included) with the latest year's data."""
    picked = _picked(
        clean,
        ["nome_autor"],
        ["genero_autor", "faixa_etaria_autor", "nacionaldade_autor", "nome_pais_autor", "sigla_pais_iso2"],
        "ano",
        store,
    )
    return picked.select(
        F.col("nome_autor").alias("author_name"),
        F.col("genero_autor").alias("author_gender"),
        F.col("faixa_etaria_autor").alias("author_age_band"),
        F.col("nacionaldade_autor").alias("author_nationality"),
        F.col("nome_pais_autor").alias("author_country"),
        F.col("sigla_pais_iso2").alias("author_country_iso2"),
    )


def dim_book_rows(clean: DataFrame, store=None) -> DataFrame:
    """One row per (title, author), first raw row's genre and country."""
    return _book_columns(_picked(clean, _BOOK_KEYS, _BOOK_VALUES, None, store))


_BOOK_KEYS, _BOOK_VALUES = ["titulo_livro", "nome_autor"], ["genero_livro", "pais_primeira_edicao"]


def _book_columns(picked: DataFrame, *more: str) -> DataFrame:
    return picked.select(
        F.col("titulo_livro").alias("title"),
        F.col("genero_livro").alias("book_genre"),
        F.col("pais_primeira_edicao").alias("first_edition_country"),
        F.col("nome_autor").alias("author_name"),
        *more,
    )


def dim_publisher_rows(clean: DataFrame, store=None) -> DataFrame:
    """One row per publisher name (case-sensitive), first raw row's attributes."""
    picked = _picked(clean, ["nome_editora"], ["sede_editora", "site_editora", "publication_type"], None, store)
    return picked.select(
        F.col("nome_editora").alias("publisher_name"),
        F.col("sede_editora").alias("publisher_seat"),
        F.col("site_editora").alias("publisher_site"),
        "publication_type",
    )


def _fact_columns(clean: DataFrame, *more) -> DataFrame:
    return clean.select(
        ROW_KEY,
        "ano",
        "nome_editora",
        F.col("indicador_vencedor").alias("is_winner"),
        F.col("indicador_finalista").alias("is_finalist"),
        F.col("indicador_semifinalista").alias("is_semifinalist"),
        "selection_level",
        *more,
    )


def rows_with_book(clean: DataFrame, hot: list[tuple]) -> DataFrame:
    """The fact's columns of every cleaned row with ``book_row``, the number of the first
    row of its (title, author); on that first row the book itself is in ``book``.

    The cleaned rows are exchanged by (title, author) once, for the choice of the book's
    row and for its lookup alike. The window holds one book's rows, of which ``hot`` keys
    are left out: their first rows are a partial aggregate, met by broadcast."""
    book = F.struct(*_BOOK_KEYS, *_BOOK_VALUES).alias("book")
    rows = _fact_columns(clean, *_BOOK_KEYS, *_BOOK_VALUES)
    out = [c for c in rows.columns if c not in (*_BOOK_KEYS, *_BOOK_VALUES)]

    def shaped(found: DataFrame) -> DataFrame:
        return found.select(*out, "book_row", F.when(F.col(ROW_KEY) == F.col("book_row"), book).alias("book"))

    first = F.min(ROW_KEY).over(Window.partitionBy(*_BOOK_KEYS))
    if not hot:
        return shaped(rows.withColumn("book_row", first))
    keys = clean.sparkSession.createDataFrame(hot, "hot_title string, hot_author string")  # at most 1 / HOT_SHARE rows
    same = rows["titulo_livro"].eqNullSafe(keys["hot_title"]) & rows["nome_autor"].eqNullSafe(keys["hot_author"])
    of_hot = rows.join(F.broadcast(keys), same, "inner").groupBy("hot_title", "hot_author").agg(F.min(ROW_KEY).alias("book_row"))
    same = rows["titulo_livro"].eqNullSafe(of_hot["hot_title"]) & rows["nome_autor"].eqNullSafe(of_hot["hot_author"])
    marked = rows.join(F.broadcast(of_hot), same, "left").drop("hot_title", "hot_author")
    cold = marked.where("book_row IS NULL").withColumn("book_row", first)
    return shaped(marked.where("book_row IS NOT NULL")).unionByName(shaped(cold))


FOREIGN_KEYS = ("time_id", "author_id", "book_id", "publisher_id")


def check_fact(fact: DataFrame, expected_rows: int) -> None:
    """Raise unless the fact has one row per cleaned row and every foreign key is
    set (one aggregate over the key columns)."""
    agg = fact.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.col(k).isNull().cast("long")).alias(k) for k in FOREIGN_KEYS],
    ).first()
    problems = [f"{k}: {agg[k]} null" for k in FOREIGN_KEYS if agg[k]]
    if agg["rows"] != expected_rows:
        problems.append(f"{agg['rows']} fact rows for {expected_rows} submissions")
    if problems:
        raise RuntimeError("fact check failed, run not published: " + "; ".join(problems))


def build_star(
    spark: SparkSession,
    raw: DataFrame,
    buckets: TimeBuckets,
    *,
    dataset: str,
    root: str | None = None,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    timings: dict | None = None,
    publish_run: bool = True,
) -> Star:
    """Run the whole ETL into a new run folder under ``root`` (default: the shared
    folder), check the fact and publish the run; returns the star read back. With
    ``publish_run=False`` the caller publishes, for example once the marts exist.
    ``timings``, when given, receives seconds per step."""
    run = new_run(spark, dataset, root)
    work = f"{run}/_work"
    with _step(timings, "clean"):
        read = Observation("raw")
        books = F.approx_count_distinct(F.xxhash64(*_BOOK_KEYS))
        observed = clean_submissions(raw).observe(read, F.count(F.lit(1)).alias("rows"), books.alias("books"))
        if is_numbered(raw):
            clean = _materialize(spark, observed, f"{run}/clean")
        else:
            # A source that gives no row numbers: they take a sort of the whole rows.
            unnumbered = _materialize(spark, observed, f"{work}/clean")
            numbered = with_dense_id(
                unnumbered, [ROW_KEY], "__number", workdir=work, rows_per_range=rows_per_range, rows=read.get["rows"]
            )
            numbered = numbered.withColumn(ROW_KEY, F.col("__number") - 1).drop("__number")
            clean = _materialize(spark, numbered, f"{run}/clean")
        raw_rows, books = read.get["rows"], read.get["books"]
        write_table(spark.createDataFrame([("raw", raw_rows)], "table_name string, row_count long"), f"{run}/input")

    clean_rows = stored_rows(spark, f"{run}/clean")
    ends = clean.agg(F.min(ROW_KEY), F.max(ROW_KEY)).first()
    if clean_rows and tuple(ends) != (0, clean_rows - 1):
        raise ValueError(f"row numbers must run from 0 to {clean_rows - 1}, not from {ends[0]} to {ends[1]}")
    small = clean_rows <= min(rows_per_range, MIN_ROWS_PER_RANGE)
    # More books than a broadcast holds: rows find their book where books are chosen.
    by_book = books > broadcast_rows

    def stored(name):
        """Write the numbers of a dimension's rows (8 bytes each) and broadcast them if few."""

        def store(chosen: DataFrame) -> DataFrame:
            path = f"{work}/{name}_rows"
            out, rows = _materialize(spark, chosen, path), stored_rows(spark, path)
            return broadcast_if_within(out, rows, 16 * rows, broadcast_rows)

        return None if small else store

    def book_rows() -> DataFrame:
        if not by_book:
            return dim_book_rows(clean, stored("dim_book"))
        found = _materialize(spark, rows_with_book(clean, hot_keys(clean, _BOOK_KEYS, clean_rows)), f"{work}/by_book")
        return _book_columns(found.where("book IS NOT NULL").select("book.*", "book_row"), "book_row")

    def build_dim(name, rows, order, id_col, cols):
        with _step(timings, name):
            rows = rows()
            if small:
                # No dimension has more rows than the cleaned table: one small
                # numbering task, dedupe and ids in a single job.
                numbered = with_dense_id(rows, order, id_col, workdir=work, at_most=clean_rows, rows_per_range=rows_per_range)
            else:
                # Materialise the dedupe once; counting and numbering read it. (Books that
                # were chosen where rows find them are a projection of a stored table.)
                if name == "dim_book" and by_book:
                    keys, n = rows, rows.count()
                else:
                    keys = _materialize(spark, rows, f"{work}/{name}")
                    n = stored_rows(spark, f"{work}/{name}")
                numbered = with_dense_id(keys, order, id_col, workdir=work, rows_per_range=rows_per_range, rows=n)
            # The book's row number stays in the stored table; readers select the dimension's columns.
            more = [c for c in numbered.columns if c == "book_row"]
            return name, _materialize(spark, numbered.select(*cols, *more), f"{run}/{name}")

    # The four dimensions are independent jobs: submit them together.
    specs = (
        ("dim_time", lambda: dim_time_rows(clean, buckets), ["year"], "time_id", ("time_id", "year", "decade", "period")),
        ("dim_author", lambda: dim_author_rows(clean, stored("dim_author")), ["author_name"], "author_id", DIM_AUTHOR_COLUMNS),
        ("dim_book", book_rows, ["title", "author_name"], "book_id", DIM_BOOK_COLUMNS),
        ("dim_publisher", lambda: dim_publisher_rows(clean, stored("dim_publisher")), ["publisher_name"], "publisher_id", DIM_PUBLISHER_COLUMNS),
    )
    with ThreadPoolExecutor(max_workers=len(specs)) as pool:
        dims = dict(pool.map(lambda spec: build_dim(*spec), specs))

    t_fact = time.perf_counter()
    by_book = spark.read.parquet(f"{work}/by_book") if by_book else None
    keyed = fact_keys(spark, clean, dims, run=run, clean_rows=clean_rows, broadcast_rows=broadcast_rows, by_book=by_book)
    # Rows are numbered where they are read, so the fact is not sorted.
    fact_out = keyed.withColumn("submission_id", F.col(ROW_KEY) + 1).select(*FACT_COLUMNS)
    if not small:
        # Without this every write task would open one file per year. AQE's
        # rebalance gives advisory-sized tasks that each hold one time_id (hot
        # years are split), for one shuffle of the narrow fact rows.
        fact_out = fact_out.hint("rebalance", "time_id")
    write_table(fact_out, f"{run}/fact_submission", ["time_id"])
    if timings is not None:
        timings["fact_submission"] = round(time.perf_counter() - t_fact, 3)

    star = read_star(spark, run)
    check_fact(star.fact_submission, raw_rows)
    drop_folder(spark, work)
    if publish_run:
        publish(spark, dataset, run, root)
    return star


def fact_keys(
    spark: SparkSession, clean: DataFrame, dims: dict, *, run: str, clean_rows: int, broadcast_rows: int, by_book: DataFrame | None
) -> DataFrame:
    """The four dimension ids, flags, level and row number of every cleaned row.

    Hot keys are sampled from stored tables, once per key, so sampling never runs a join."""

    def sizes(name: str) -> dict:
        return {"dim_rows": stored_rows(spark, f"{run}/{name}"), "dim_bytes": stored_bytes(spark, f"{run}/{name}")}

    def lookup(rows, source, n_rows, name, dim, on, take):
        bounds = sizes(name)
        fits = bounds["dim_rows"] <= broadcast_rows and bounds["dim_bytes"] <= BROADCAST_BYTES
        hot = [] if fits else hot_keys(source, [k for k, _ in on], n_rows)
        return null_safe_lookup(rows, dim, on, take, max_broadcast_rows=broadcast_rows, hot=hot, **bounds)

    # Every (title, author) book row names its author, so the author id is first
    # attached to the book keys (a join of two dimensions), and one fact join on
    # the book then yields both ids: one fact shuffle instead of two.
    books = dims["dim_book"]
    key = ["first_row"] if by_book is not None else ["title", "author_name"]
    book_keys = lookup(
        books.select(F.col("book_row").alias("first_row"), "author_name", "book_id")
        if by_book is not None
        else books.select("title", "author_name", "book_id"),
        books,
        stored_rows(spark, f"{run}/dim_book"),
        "dim_author",
        dims["dim_author"],
        [("author_name", "author_name")],
        ["author_id"],
    ).select(*key, "book_id", "author_id")
    if by_book is not None:
        facts, source, on = by_book.drop("book"), by_book, [("book_row", "first_row")]
    else:
        facts, source, on = _fact_columns(clean, *_BOOK_KEYS), clean, list(zip(_BOOK_KEYS, key, strict=True))
    facts = lookup(facts, clean, clean_rows, "dim_time", dims["dim_time"], [("ano", "year")], ["time_id"])
    facts = lookup(facts, source, clean_rows, "dim_book", book_keys, on, ["book_id", "author_id"])
    facts = lookup(
        facts, clean, clean_rows, "dim_publisher", dims["dim_publisher"], [("nome_editora", "publisher_name")], ["publisher_id"]
    )
    return facts.select(ROW_KEY, *[c for c in FACT_COLUMNS if c != "submission_id"])


def read_clean(spark: SparkSession, star: Star) -> DataFrame:
    """The cleaned submissions table of the run (without the hidden row key)."""
    return spark.read.parquet(f"{star.path}/clean").drop(ROW_KEY)
