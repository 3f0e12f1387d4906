"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from rowtide.plans.oracle import ORACLE
from rowtide.plans.queries import QUERIES
from rowtide.plans.stream_queries import STREAM_QUERIES

ALL = QUERIES | STREAM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA or v is pd.NaT:
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(plain(v) for v in row) for row in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_matches_sql(spark, duck, name):
    got = ALL[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
    assert len(got) > 0


def test_every_query_has_a_twin():
    assert set(ALL) == set(ORACLE)
    assert set(ALL) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
