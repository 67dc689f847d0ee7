"""Tables that a warehouse builds once: kept while they are there, built again when gone, listed when asked for."""

from __future__ import annotations

import datetime as dt
import shutil

import pytest

import __spark_entry__ as entry
from playmart.plans import players
from playmart.plans.warehouse import Warehouse

QUERIES = entry.queries()
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
KINDS = ("signup", "view", "click", "error", "purchase")


@pytest.fixture
def events_dir(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 30, i % 24), i % 9, KINDS[i % 5], i / 4, '{"k": %d}' % (i % 7)) for i in range(300)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def _rows(spark, key, d):
    return sorted(map(str, QUERIES[key](spark, d).collect()))


def _folder(df) -> str:
    return df.inputFiles()[0].split("/event_date=")[0].removeprefix("file:").replace("///", "/")


def test_tables_that_are_gone_are_built_again(spark, events_dir):
    """The shared folder is emptied between two queries of one session: the second builds its tables, and its rows
    are those of a session that was left alone."""
    want = {k: _rows(spark, k, events_dir) for k in ("dau_and_revenue", "coins_balance", "fail_rate")}
    w = Warehouse.shared(spark, events_dir)
    assert want["dau_and_revenue"] and Warehouse.shared(spark, events_dir) is w  # nothing is built twice
    shutil.rmtree(_folder(w.stg_events))
    for k, rows in want.items():
        assert _rows(spark, k, events_dir) == rows, k
    assert Warehouse.shared(spark, events_dir) is not w


def test_event_queries_write_nothing_to_the_catalog(spark, events_dir):
    """Models read their tables by path; the database is made when it is asked for, and lists what was built before."""
    before = {d.name for d in spark.catalog.listDatabases()}
    assert _rows(spark, "cohort_ltv_daily", events_dir)
    assert {d.name for d in spark.catalog.listDatabases()} == before
    w = Warehouse.shared(spark, events_dir)
    assert [t.name for t in spark.catalog.listTables(w.database)] == ["stg_events"]


def test_row_counts_leave_out_versions_of_the_player_dimension(spark, events_dir):
    w = Warehouse(spark, events_dir, materialize=True)
    players.load(spark, w.stg_events, f"{events_dir}/players", w.as_of, w.database, buckets=2)
    assert len(spark.catalog.listTables(w.database)) > 1
    assert list(w.catalog()) == ["stg_events"]
    w.model_table("sheet", lambda: spark.range(3))
    assert sorted(w.catalog()) == ["sheet", "stg_events"]
