"""Every registered query against its DuckDB oracle (sf0.001; the driver runs sf0.01)."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from conftest import SF_SMALL
from oracle_compare import compare, duck_connection

# The training-data operators have their own tests.
KEYS = sorted(k for k in queries() if k != "pipeline" and not re.match(r"op\d+_", k))


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) >= set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    problems, _, _, _ = compare(spark, con, key, queries()[key], oracle_sql()[key], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 7
    assert df.columns[:2] == ["year", "inscritos"]
