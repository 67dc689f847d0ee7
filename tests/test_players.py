"""The player dimension: daily loads equal one pass over all events, read new days only and shuffle no stored row."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playmart.operators import analytics, marts
from playmart.operators.players import player_facts
from playmart.plans import players
from playmart.plans.warehouse import Warehouse

DAYS = [dt.date(2024, 1, d) for d in (24, 25, 25, 28, 30)]  # one day is repeated, two gaps


def rows(df):
    df = df.withColumn("iap_value_usd", F.round("iap_value_usd", 6)) if "iap_value_usd" in df.columns else df
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def events(spark, sf_dir, tmp_root):
    w = Warehouse(spark, sf_dir)
    path = f"{tmp_root}/player-events"
    touched = F.col("event_name").isin("first_open", "new_player") & (F.crc32("user_pseudo_id") % 4 == 0)
    w.stg_events.where(~touched).write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def loaded(spark, events, tmp_root):
    out = f"{tmp_root}/players"
    return out, [players.load(spark, events, out, d, buckets=4) for d in DAYS]


def test_daily_loads_equal_one_pass(events, loaded):
    for day, df in zip(DAYS[2:], loaded[1][2:]):
        want = rows(player_facts(events.where(F.col("event_date") <= F.lit(day))))
        assert rows(df) == want and len(want) > 10
    last = loaded[1][-1]
    assert last.where("first_spend is not null").count() > 0 and last.where("touch is null").count() > 0


def test_models_give_the_same_rows_with_the_dimension(events, loaded):
    dim = loaded[1][-1]
    for inc in (False, True):
        fields = lambda df: rows(df.withColumns({c: F.round(c, 6) for c in ("iap_revenue", "arpdau_iap")}))
        assert fields(marts.iap_arpdau_daily(events, DAYS[-1], inc, dim)) == fields(marts.iap_arpdau_daily(events, DAYS[-1], inc))
    fields = lambda df: rows(df.withColumn("total_iap_value_usd", F.round("total_iap_value_usd", 6)))
    assert fields(analytics.retention_cohorts(events, dim)) == fields(analytics.retention_cohorts(events))


def test_a_changed_day_in_the_look_back_is_taken_back(spark, events, loaded):
    """A user whose only spend is withdrawn before it left the look-back is no spender afterwards."""
    out, _ = loaded
    late = events.where(F.col("event_date") > F.lit(DAYS[-1] - dt.timedelta(days=players.LOOKBACK_DAYS + 1)))
    changed = events.join(late.select("event_date").distinct(), "event_date", "left_anti").select(*events.columns)
    got = players.load(spark, changed, out, DAYS[-1], buckets=4)
    assert rows(got) == rows(player_facts(changed))
    assert rows(players.load(spark, events, out, DAYS[-1], buckets=4)) == rows(player_facts(events))


def test_incremental_mart_reads_the_look_back_and_shuffles_no_player(spark, events, loaded):
    dim = loaded[1][-1]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = marts.iap_arpdau_daily(events, DAYS[-1], True, dim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert sum("event_date" in s and ">= 2024-01-16" in s for s in scans) == 1
    side = plan[plan.index("SortMergeJoin"):].split("FileScan")[-1 if "Bucketed: true" in scans[-1] else 1]
    assert "SelectedBucketsCount: 4 out of 4" in side
    # between the join and the bucketed scan there is no exchange
    lines = plan.splitlines()
    scan = next(i for i, s in enumerate(lines) if "SelectedBucketsCount" in s)
    depth = lambda s: len(s) - len(s.lstrip(" :+-*"))
    join = next(i for i, s in enumerate(lines) if "SortMergeJoin" in s)
    branch = [s for s in lines[join + 1:scan] if s.lstrip(" ").startswith("+-") or depth(s) > depth(lines[join])]
    last_side = branch[max(i for i, s in enumerate(branch) if depth(s) == min(map(depth, branch))):]
    assert not any("Exchange" in s for s in last_side)


def test_full_starts_again_and_other_bucket_counts_stand_apart(spark, events, loaded):
    out, _ = loaded
    want = rows(player_facts(events))
    assert rows(players.load(spark, events, out, DAYS[-1], buckets=4, full=True)) == want
    assert [c for c in players.children(spark, f"{out}/buckets=4") if c.startswith("through=")] == ["through=2024-01-27"]
    assert rows(players.load(spark, events, out, DAYS[-1], buckets=3)) == want


def test_no_events(spark, events, tmp_root):
    got = players.load(spark, events.limit(0), f"{tmp_root}/no-players", DAYS[0], buckets=2)
    assert got.count() == 0 and set(got.columns) == {"user_pseudo_id", "touch", "first_spend", "iap_value_usd"}
