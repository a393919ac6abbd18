"""ETL outputs exposed as queries: cleaned rows, CSV round trip, run report
counts, star tables and a full-refresh warehouse round trip."""

from __future__ import annotations

import dataclasses
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.clean import clean_submissions
from starmart.operators.dense_ids import with_dense_id
from starmart.operators.lookup import input_bytes
from starmart.operators.ordering import desc, ordered
from starmart.plans.reports import q07
from starmart.plans.star import dim_author_rows
from starmart.sources.csv import read_submissions_csv, write_submissions_csv
from starmart.sources.schemas import DIM_AUTHOR_COLUMNS, RAW_COLUMNS, ROW_KEY
from starmart.sources.warehouse import (
    STAR_TABLES,
    Star,
    dataset_base,
    drop_folder,
    free_shuffles,
    read_star,
    write_star,
    write_table,
)

CLEAN_COLUMNS = (*RAW_COLUMNS, "selection_level", "publication_type")

_ID_OF = {
    "dim_time": "time_id",
    "dim_author": "author_id",
    "dim_book": "book_id",
    "dim_publisher": "publisher_id",
    "fact_submission": "submission_id",
}


def clean_rows(spark: SparkSession, star: Star) -> DataFrame:
    """The cleaned submissions of the run, in the raw column names."""
    return spark.read.parquet(f"{star.path}/clean").select(*CLEAN_COLUMNS)


def _csv_folder(spark: SparkSession, dataset: str) -> str:
    return f"{dataset_base(spark, dataset)}/csv/{uuid.uuid4().hex}"


def csv_roundtrip(spark: SparkSession, raw: DataFrame, dataset: str) -> DataFrame:
    """Write raw rows as CSV into the shared folder, read them back through the
    CSV source (null tokens, multi-line cells) and clean them."""
    path = _csv_folder(spark, dataset)
    write_submissions_csv(raw, path)
    return clean_submissions(read_submissions_csv(spark, path)).select(*CLEAN_COLUMNS)


def csv_reordered(spark: SparkSession, raw: DataFrame, dataset: str) -> DataFrame:
    """The same with the columns in another order and one column more: cells are
    bound by header name."""
    path = _csv_folder(spark, dataset)
    order = [*reversed(RAW_COLUMNS[:9]), "extra", *RAW_COLUMNS[9:]]
    write_submissions_csv(raw.withColumn("extra", F.lit("x")), path, order)
    return clean_submissions(read_submissions_csv(spark, path)).select(*CLEAN_COLUMNS)


def edge_cells(raw: DataFrame) -> DataFrame:
    """Plant hard cells by row key: missing-value tokens (padded, and in the year),
    wide white space, blank and empty cells, quotes, line breaks, an unknown band."""
    kind = F.col(f"{ROW_KEY}.l_orderkey") % 11

    def plant(name: str, *cases) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for k, value in cases:
            out = out.when(kind == k, value)
        return out.otherwise(F.col(name).cast("string")).alias(name)

    cells = {
        "ano": plant("ano", (5, F.lit("N/A"))),
        "titulo_livro": plant(
            "titulo_livro", (0, F.lit("NA")), (4, F.concat(F.lit('say "'), F.col("titulo_livro"), F.lit('"\nsecond')))
        ),
        "nome_autor": plant(
            "nome_autor", (1, F.lit(" NA ")), (2, F.when(F.col("nome_autor").isNull(), F.lit("\xa0\u2003")).otherwise(F.concat(F.lit("\xa0"), F.col("nome_autor"), F.lit("\u2003"))))
        ),
        "genero_autor": plant("genero_autor", (3, F.lit("  \xa0")), (6, F.lit(""))),
        "faixa_etaria_autor": plant("faixa_etaria_autor", (7, F.lit("sem idade"))),
        "nome_editora": plant("nome_editora", (8, F.lit("null"))),
    }
    return raw.select(ROW_KEY, *[cells.get(c, F.col(c)) for c in RAW_COLUMNS])


def csv_edge(spark: SparkSession, raw: DataFrame, dataset: str) -> DataFrame:
    """Rows with hard cells through the CSV source and the cleaning."""
    return csv_roundtrip(spark, edge_cells(raw), dataset)


#: Rows of one CSV file; one task writes it. About 0.7 GB of records of the test tables.
ROWS_PER_FILE = 4_000_000
#: Files that are on disk at a time: text takes many times the disk of packed columns.
FILES_PER_ROUND = 8
#: Input per part of the rows that are joined at a time, and the most parts: each reads all
#: of the input anew, so beyond them the parts grow.
PART_BYTES, MOST_PARTS = 1 << 30, 8


def csv_one_file(
    spark: SparkSession,
    raw: DataFrame,
    dataset: str,
    rows_per_file: int = ROWS_PER_FILE,
    files_per_round: int = FILES_PER_ROUND,
) -> DataFrame:
    """Every title with commas, quotes and line breaks, all rows in one CSV file, or beyond
    ``rows_per_file`` in some files of at most so many: the reader splits them by block,
    though their records run over lines. (Large files are the case to read here; loads write
    as many as they have tasks. One file has one writer, so its rows are bounded.)

    More rows than ``files_per_round`` files hold go through CSV in rounds: the files of a
    round are written, read and cleaned, its cleaned rows are stored, and its files go before
    the next, so the text on disk is bounded however many rows there are."""
    lines = F.concat(F.lit('say "'), F.col("titulo_livro"), F.lit('",\n\n"two"\r\nthree'))
    path = _csv_folder(spark, dataset)
    # Stored first: their number is known, the joins run once for a row, and a writer reads
    # packed columns of some splits instead of a shuffle of whole rows.
    parts, stored = [], []
    for part in _parts(raw.withColumn("titulo_livro", lines)):
        parts.append(f"{path}/rows/{len(parts)}")
        write_table(part.select(*RAW_COLUMNS), parts[-1], file_rows=rows_per_file)
        free_shuffles(spark)
        counts = spark.read.parquet(parts[-1]).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
        stored += [(f"{parts[-1]}/{r['name']}", r["n"]) for r in counts.collect()]  # a row per file
    rounds = _rounds(stored, rows_per_file * files_per_round)
    if len(rounds) <= 1:
        clean = _through_files(spark, parts, sum(n for _, n in stored), f"{path}/csv", rows_per_file)
        drop_folder(spark, f"{path}/rows")
        return clean
    for k, (names, n) in enumerate(rounds):
        write_table(_through_files(spark, names, n, f"{path}/csv/{k}", rows_per_file), f"{path}/clean/{k}")
        for done in (f"{path}/csv/{k}", *names):
            drop_folder(spark, done)
        free_shuffles(spark)
    return spark.read.parquet(*[f"{path}/clean/{k}" for k in range(len(rounds))])


def _parts(raw: DataFrame) -> list[DataFrame]:
    """The rows in parts for each PART_BYTES of input, so that a part of the joins' shuffles is
    on disk at a time. Parts go by the first field of the row key: Spark takes the condition to
    the scans of all tables that are joined by it (lines and orders)."""
    n = min(MOST_PARTS, -(-input_bytes(raw) // PART_BYTES))
    kind = raw.schema[ROW_KEY].dataType
    key = F.col(ROW_KEY)[kind.names[0]] if isinstance(kind, T.StructType) else F.col(ROW_KEY)
    return [raw.where(F.pmod(F.xxhash64(key), F.lit(n)) == k) for k in range(n)] if n > 1 else [raw]


def _rounds(stored: list[tuple[str, int]], most: int) -> list[tuple[list[str], int]]:
    """Files with their rows in groups of at most ``most`` rows, and the rows of each."""
    out: list[tuple[list[str], int]] = []
    for name, n in sorted(stored):
        names, rows = out.pop() if out and out[-1][1] + n <= most else ([], 0)
        out.append(([*names, name], rows + n))
    return out


def _through_files(spark: SparkSession, stored: list[str], rows: int, path: str, rows_per_file: int) -> DataFrame:
    """Stored rows written to as few CSV files as may hold them, read back and cleaned."""
    files = max(1, -(-rows // rows_per_file))
    write_submissions_csv(spark.read.parquet(*stored).coalesce(files), path, file_rows=rows_per_file)
    return clean_submissions(read_submissions_csv(spark, path)).select(*CLEAN_COLUMNS)


def author_missing_year(spark: SparkSession, raw: DataFrame, dataset: str) -> DataFrame:
    """The author dimension where some rows lack the year: they are older than any
    other row of their author."""
    gone = (F.col(f"{ROW_KEY}.l_orderkey") % 5 == 0) | (F.col(f"{ROW_KEY}.l_partkey") % 7 == 0)
    clean = clean_submissions(raw.withColumn("ano", F.when(~gone, F.col("ano"))))
    work = f"{dataset_base(spark, dataset)}/work/{uuid.uuid4().hex}"
    return with_dense_id(dim_author_rows(clean), ["author_name"], "author_id", workdir=work).select(*DIM_AUTHOR_COLUMNS)


def no_winner(star: Star) -> DataFrame:
    """The gender profile (q07) of the rows that did not win: shares of nothing are null."""
    losers = star.fact_submission.where("is_winner = 0")
    return q07(dataclasses.replace(star, fact_submission=losers))


def level_counts(clean: DataFrame) -> DataFrame:
    """Frequency of each selection level, most frequent first."""
    return ordered(clean.groupBy("selection_level").agg(F.count(F.lit(1)).alias("count")), [desc("count")], ["selection_level"])


def row_counts(spark: SparkSession, star: Star) -> DataFrame:
    """Run report: the raw rows that the load read, and the row count of the five star tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in star.tables().items()]
    return reduce(DataFrame.unionByName, parts, spark.read.parquet(f"{star.path}/input"))


def warehouse_roundtrip(spark: SparkSession, star: Star, dataset: str) -> DataFrame:
    """Write a warehouse location with half of the star, then with all of it, read it
    back and audit it through SQL: nothing of the first write may remain."""
    path = f"{dataset_base(spark, dataset)}/roundtrip/{uuid.uuid4().hex}"
    half = {name: df.where(F.col(_ID_OF[name]) % 2 == 0) for name, df in star.tables().items()}
    write_star(Star(**half), path)
    write_star(star, path)
    back = read_star(spark, path)
    prefix = f"wh_{uuid.uuid4().hex[:8]}_"
    for name, df in back.tables().items():
        df.createOrReplaceTempView(prefix + name)
    sql = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST(SUM({_ID_OF[t]}) AS BIGINT) AS id_sum FROM {prefix}{t}"
        for t in STAR_TABLES
    )
    return spark.sql(sql)
