"""Every registered query against its SQL in DuckDB."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

# The queries of the folder for training data have their own tests.
NAMES = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def folder_dir(spark, tmp_path_factory):
    """The events as a folder of many files, as on a cluster."""
    path = tmp_path_factory.mktemp("tables")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    # One after the other, so that files arrive in the order of events.
    for part in range(6):
        chosen = events.filter(F.floor(F.col("event_id") * 6 / events.count()) == part)
        chosen.coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    return str(path)


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in data)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    duck_types = {c[0]: str(c[1]) for c in want.description}
    expected = want.fetchall()
    assert len(expected) > 0
    assert rows(got.columns, got.collect()) == rows(names, expected)
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    assert {n: same[t] for n, t in got.dtypes} == duck_types


@pytest.mark.parametrize(
    "name", ["latest_per_key", "alert_render", "adapt_feed", "stream_latest", "stream_view", "stream_alerts"]
)
def test_query_on_folder(spark, duck, folder_dir, name, monkeypatch):
    monkeypatch.setattr("fieldgauge.plans.streams.FILE_BYTES", 20_000)
    got = contract.queries()[name](spark, folder_dir)
    want = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())
