"""Submissions CSV: read (header, UTF-8, multi-line quoted cells) and write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import null_tokens_to_null
from starmart.operators.spread import spread
from starmart.sources.quoted_lines import csv_records
from starmart.sources.schemas import RAW_COLUMNS, ROW_KEY


def _options(reader, multiline: bool):
    return (
        reader.option("header", True)
        .option("encoding", "UTF-8")
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _year(text) -> Column:
    """A year cell as int; text that is no integer fails the read."""
    year = text.try_cast("int")
    wrong = F.concat(F.lit("not a year: "), text)
    return F.when(text.isNull() | year.isNotNull(), year).otherwise(F.raise_error(wrong).cast("int"))


def _header_names(spark: SparkSession, path: str, multiline: bool) -> list[str]:
    names = _options(spark.read, multiline).option("inferSchema", False).csv(path).columns
    if missing := sorted(set(RAW_COLUMNS) - set(names)):
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    return names


def _parsed(records: DataFrame, names: list[str]) -> DataFrame:
    """The cells of CSV records under their header names; every file's header must be ``names``."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    kind = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = records.withColumn("cells", F.from_csv("record", kind, options))
    same = F.lit(True)
    for i, field in enumerate(schema.fields):
        # An empty name is read as _c and its place.
        same = same & (F.lower(F.coalesce(F.col("cells")[field.name], F.lit(f"_c{i}"))) == field.name.lower())
    wrong = F.raise_error(F.concat(F.lit("another header than the first file's: "), F.col("record"))).cast("boolean")
    return rows.where(F.when(~F.col("header"), True).when(same, False).otherwise(wrong))


def _submissions(rows: DataFrame, row_key: Column, cell) -> DataFrame:
    cells = {c: null_tokens_to_null(cell(c)) for c in RAW_COLUMNS}
    cells["ano"] = _year(cells["ano"])
    return rows.select(row_key.alias(ROW_KEY), *[cells[c].alias(c) for c in RAW_COLUMNS])


def read_submissions_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read the raw submissions file(s), columns bound by header name.

    * The columns may stand in any order, and further columns are ignored; a
      missing one is an error. Every file must have the first one's header.
    * Quoted cells may hold line breaks and doubled quotes. Files are split by block
      all the same: a first pass over the quotes (run here, a row per split comes
      back) tells which blocks start inside a cell. A record ends at a line feed,
      with or without a carriage return before it; a file that has carriage returns
      alone is read by one task. ``multiline=False`` saves the pass for files
      without line breaks inside cells.
    * Missing-value tokens (``NA``, ``null``, empty cell, ...) become null in every
      column, the year included, before any stripping. Any other year that is no
      integer fails the read, and so does a row with fewer or more cells than the
      header (``FAILFAST``).
    * ``row_key`` keeps the source order: the number of the row in the whole input, from
      0, or where files are read without the pass file, split start, position in split.
    """
    names = _header_names(spark, path, multiline)
    first = spark.read.option("lineSep", "\n").text(path).select(F.expr("rtrim('\r', value)").contains("\r")).first() if multiline else None
    if first is None or first[0]:
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        reader = _options(spark.read.schema(schema), multiline).option("mode", "FAILFAST")
        raw = reader.option("enforceSchema", False).option("columnPruning", False).csv(path)
        row_key = F.struct(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("position"),
        )
        rows = _submissions(raw, row_key, F.col)
        # Unsplit files; the row key is fixed while reading, and spreading keeps it.
        return spread(rows, splits=len(raw.inputFiles())) if multiline else rows
    records, splits = csv_records(spark, path)
    rows = _parsed(spread(records, splits), names)
    return _submissions(rows, F.col("number"), lambda c: F.col("cells")[c])


def write_submissions_csv(df: DataFrame, path: str, columns=RAW_COLUMNS, file_rows: int = 0) -> None:
    """Write the raw columns (or ``columns``) as CSV with header; padding is kept verbatim.
    ``file_rows`` bounds the rows of a file (0: one file per task)."""
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", file_rows)
        .csv(path)
    )
