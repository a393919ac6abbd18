"""Warehouse storage: star tables as Parquet in a shared folder, full-refresh writes.

Layout under the root the caller names, or the session's ``spark.checkpoint.dir``::

    <root>/starmart/<dataset>/runs/<run-id>/{input,clean,dim_time,...,fact_submission,marts/...}
    <root>/starmart/<dataset>/PUBLISHED/<number>.json    append-only records: (number, run folder)

A refresh writes a complete new run folder and adds its publish record last,
so a failure midway never leaves readers on a half-written mix of tables. Records are
numbered; each number is created once, by whoever comes first, so their order is that of
publishing and hangs on no clock.
"""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from dataclasses import dataclass, fields

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources.schemas import DIM_AUTHOR_COLUMNS, DIM_BOOK_COLUMNS, DIM_PUBLISHER_COLUMNS, FACT_COLUMNS

STAR_TABLES = ("dim_time", "dim_author", "dim_book", "dim_publisher", "fact_submission")

# The table and column names of the source application's warehouse,
# under which register_views(source_names=True) exposes the star, so SQL written
# for it runs unchanged.
SOURCE_NAMES = {
    "dim_time": ("dim_tempo", {"time_id": "id_tempo", "year": "ano", "decade": "decada", "period": "periodo"}),
    "dim_author": (
        "dim_autor",
        {
            "author_id": "id_autor",
            "author_name": "nome_autor",
            "author_gender": "genero_autor",
            "author_age_band": "faixa_etaria_autor",
            "author_nationality": "nacionaldade_autor",
            "author_country": "nome_pais_autor",
            "author_country_iso2": "sigla_pais_iso2",
        },
    ),
    "dim_book": (
        "dim_livro",
        {
            "book_id": "id_livro",
            "title": "titulo_livro",
            "book_genre": "genero_livro",
            "first_edition_country": "pais_primeira_edicao",
            "author_name": "nome_autor",
        },
    ),
    "dim_publisher": (
        "dim_editora",
        {
            "publisher_id": "id_editora",
            "publisher_name": "nome_editora",
            "publisher_seat": "sede_editora",
            "publisher_site": "site_editora",
            "publication_type": "tipo_publicacao",
        },
    ),
    "fact_submission": (
        "fato_inscricao",
        {
            "submission_id": "id_inscricao",
            "time_id": "id_tempo",
            "author_id": "id_autor",
            "book_id": "id_livro",
            "publisher_id": "id_editora",
            "is_winner": "indicador_vencedor",
            "is_finalist": "indicador_finalista",
            "is_semifinalist": "indicador_semifinalista",
            "selection_level": "nivel_selecao",
        },
    ),
}

_FACT_SCHEMA = (
    "submission_id long, author_id long, book_id long, publisher_id long, "
    "is_winner int, is_finalist int, is_semifinalist int, selection_level string, time_id long"
)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for materialised tables: the session's checkpoint dir.

    Only a single-machine session (``local`` or ``local[n]``) may leave it unset;
    a private folder is then made and set for the application. Other processes
    cannot find it: to reopen a warehouse later, name its root.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def dataset_base(spark: SparkSession, dataset: str, root: str | None = None) -> str:
    return f"{(root or shared_root(spark)).rstrip('/')}/starmart/{dataset}"


def new_run(spark: SparkSession, dataset: str, root: str | None = None) -> str:
    stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime())
    return f"{dataset_base(spark, dataset, root)}/runs/{stamp}-{uuid.uuid4().hex[:8]}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this warehouse wrote (runs and what is below them)."""
    if "/starmart/" not in path:
        raise ValueError(f"not a warehouse folder: {path}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_old_runs(spark: SparkSession, dataset: str, keep: int = 2, root: str | None = None) -> list[str]:
    """Delete all but the ``keep`` last published runs; returns what went. Runs are
    never dropped otherwise: readers may still be on an older one."""
    old = [r["run"] for r in _published(spark, dataset, root)][max(keep, 1) :]
    for run in old:
        drop_folder(spark, run)
    return old


def free_shuffles(spark: SparkSession) -> None:
    """Let the files of shuffles go that nothing refers to any more. Spark deletes them when
    the driver's garbage collection finds the shuffle gone, on an idle driver much later."""
    spark._jvm.System.gc()


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, file_rows: int = 0) -> None:
    """``file_rows`` bounds the rows of a file (0: as the session has it)."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.parquet(path)


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist; False if it does. The file system decides,
    so of several writers one succeeds."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        # Hadoop looks and then creates on a local disk; the system call does both at once.
        try:
            with open(where.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(where, False)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def publish(spark: SparkSession, dataset: str, run_path: str, root: str | None = None) -> int:
    """Record a completely written run folder as the current one; returns the record's number.

    A record is one line in a file of its own. Who finds the next number taken takes the
    one after it. A line is read only once it is whole, and older records keep the history
    of refreshes.
    """
    folder = f"{dataset_base(spark, dataset, root)}/PUBLISHED"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    number = max((int(n[:12]) for n in names if re.fullmatch(r"\d{12}\.json", n)), default=0) + 1
    while not _create_once(spark, f"{folder}/{number:012d}.json", json.dumps({"number": number, "run": run_path}) + "\n"):
        number += 1
    return number


def _published(spark: SparkSession, dataset: str, root: str | None = None) -> list:
    """The publish records, the latest first; none before the first refresh. (Records of
    earlier versions have a stamp and no number, and are older.)"""
    try:
        records = spark.read.schema("number long, published_ns long, run string").json(f"{dataset_base(spark, dataset, root)}/PUBLISHED")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    latest = [F.col("number").desc_nulls_last(), F.col("published_ns").desc(), F.col("run").desc()]
    return records.where("run IS NOT NULL").orderBy(*latest).collect()


def current_run(spark: SparkSession, dataset: str, root: str | None = None) -> str | None:
    """The run folder of the latest publish record, or None before the first."""
    records = _published(spark, dataset, root)
    return records[0]["run"] if records else None


@dataclass(frozen=True)
class Star:
    """The four dimensions and the fact table of one warehouse run."""

    dim_time: DataFrame
    dim_author: DataFrame
    dim_book: DataFrame
    dim_publisher: DataFrame
    fact_submission: DataFrame
    path: str | None = None
    #: Folders of tables that are not stored under ``path``.
    paths: dict[str, str] | None = None

    def broadcast_rows(self, name: str) -> int | None:
        """Row count of a stored table whose estimated size may be broadcast; None
        for a larger one, or one that no run folder holds."""
        if self.path is None:
            return None
        from starmart.operators.lookup import BROADCAST_BYTES, stored_bytes, stored_rows

        spark, path = getattr(self, name).sparkSession, (self.paths or {}).get(name, f"{self.path}/{name}")
        return stored_rows(spark, path) if stored_bytes(spark, path) <= BROADCAST_BYTES else None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("path", "paths")}

    def register_views(self, source_names: bool = False) -> None:
        """Expose the tables to ``spark.sql`` (ad-hoc SQL): under their own names,
        or with ``source_names`` under the source application's table and column
        names (renaming is a projection; scans stay pruned and pushed down)."""
        for name, df in self.tables().items():
            if source_names:
                view, columns = SOURCE_NAMES[name]
                df.withColumnsRenamed(columns).createOrReplaceTempView(view)
            else:
                df.createOrReplaceTempView(name)


def write_star(star: Star, path: str) -> None:
    for name, df in star.tables().items():
        # The fact is partitioned by its time key: a year filter on dim_time then
        # prunes fact partitions (dynamic partition pruning).
        write_table(df, f"{path}/{name}", ["time_id"] if name == "fact_submission" else None)


def read_star(spark: SparkSession, path: str) -> Star:
    read = spark.read.parquet
    return Star(
        dim_time=read(f"{path}/dim_time"),
        dim_author=read(f"{path}/dim_author").select(*DIM_AUTHOR_COLUMNS),
        dim_book=read(f"{path}/dim_book").select(*DIM_BOOK_COLUMNS),
        dim_publisher=read(f"{path}/dim_publisher").select(*DIM_PUBLISHER_COLUMNS),
        fact_submission=spark.read.schema(_FACT_SCHEMA).parquet(f"{path}/fact_submission").select(*FACT_COLUMNS),
        path=path,
    )


def open_star(spark: SparkSession, dataset: str, root: str | None = None) -> Star:
    """The star of the latest published run (the last complete refresh)."""
    run = current_run(spark, dataset, root)
    if run is None:
        raise FileNotFoundError(f"no published warehouse run for dataset {dataset!r} under {dataset_base(spark, dataset, root)}")
    return read_star(spark, run)
