"""Every registered query equals its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from checks.compare import digest, duck
from tests.conftest import SF_SMALL

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_library_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["shard", "chunk", "n_tokens", "ids_md5", "labels_md5"]


@pytest.mark.parametrize("name", [n for n in NAMES if n in E.oracle_sql()])
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(cols, drows)


@pytest.mark.parametrize("name", ["throughput", "progress", "stream_loss_windows", "window_assign"])
def test_time_queries_independent_of_session_time_settings(spark, con, name):
    keys = ("spark.sql.parquet.inferTimestampNTZ.enabled", "spark.sql.session.timeZone")
    old = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "America/New_York")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    res = con.execute(E.oracle_sql()[name])
    assert digest(df.columns, rows) == digest([d[0] for d in res.description], res.fetchall())
