"""Warehouses built from the driver's test tables, one per input folder and
Spark application: the first query builds and publishes it, later ones read it."""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.sql import SparkSession

from starmart.params import TESTDATA_YEARS
from starmart.session import application_id
from starmart.operators.lookup import DEFAULT_BROADCAST_ROWS, stored_version
from starmart.sources.staging import SOURCE_TABLES, staging_submissions
from starmart.sources.warehouse import Star, dataset_base, drop_folder, read_star

_lock = threading.Lock()
_runs: dict[tuple, str] = {}


def dataset_name(sf_dir: str) -> str:
    path = os.path.abspath(sf_dir)
    digest = hashlib.sha1(path.encode()).hexdigest()[:10]
    return f"{os.path.basename(path.rstrip('/')) or 'data'}-{digest}"


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes when a table that the warehouse is built from changes."""
    return tuple(stored_version(spark, f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES)


def load_testdata(spark: SparkSession, sf_dir: str, dataset: str, broadcast_rows: int = DEFAULT_BROADCAST_ROWS, **options) -> Star:
    """Run the whole ETL over the test tables."""
    from starmart.plans.star import build_star

    work = f"{dataset_base(spark, dataset)}/work/{uuid.uuid4().hex}"
    raw = staging_submissions(spark, sf_dir, broadcast_rows, work)
    star = build_star(spark, raw, TESTDATA_YEARS, dataset=dataset, broadcast_rows=broadcast_rows, **options)
    drop_folder(spark, work)
    return star


def testdata_star(spark: SparkSession, sf_dir: str) -> Star:
    key = (application_id(spark), os.path.abspath(sf_dir), _version(spark, sf_dir), "star")
    with _lock:
        if key not in _runs:
            _runs[key] = load_testdata(spark, sf_dir, dataset_name(sf_dir)).path
    return read_star(spark, _runs[key])


def testdata_marts(spark: SparkSession, sf_dir: str):
    """Stored dashboard marts (d01-d10) of the test warehouse."""
    from starmart.plans.marts import build_marts, read_marts

    star = testdata_star(spark, sf_dir)
    key = (application_id(spark), star.path, "marts")
    with _lock:
        if key not in _runs:
            build_marts(spark, star)
            _runs[key] = star.path
    return read_marts(spark, _runs[key])
