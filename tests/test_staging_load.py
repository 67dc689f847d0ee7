"""Staging loaded day by day equals one full load, reads the look-back only and can be repeated."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from playmart.operators import staging
from playmart.plans import staging_load
from playmart.sources import fixtures
from playmart.sources.tables import read_table

DAYS = [dt.date(2024, 1, d) for d in (26, 27, 28, 30)]  # one day is skipped


def land(spark, events, landing, as_of, days):
    """The finalized shards of ``days`` and the snapshot of ``as_of``, as an export writes them."""
    raw = fixtures.raw_ga4_events(events.where(F.col("ts") < F.lit(as_of + dt.timedelta(days=1))), as_of)
    for suffix in [d.strftime("%Y%m%d") for d in days] + [as_of.strftime("intraday_%Y%m%d")]:
        raw.where(F.col("table_suffix") == suffix).drop("table_suffix").coalesce(1).write.mode("overwrite") \
            .parquet(f"{landing}/table_suffix={suffix}")


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, df.select(*cols).collect()))


@pytest.fixture(scope="module")
def loaded(spark, sf_dir, tmp_root):
    """Four daily runs; the third one finds a changed shard in its look-back."""
    events = read_table(spark, sf_dir, "events").where("user_id % 7 < 3")  # few players: levels go on over days
    events = events.withColumn("user_id", F.col("user_id") % 5)
    landing, out = f"{tmp_root}/ga4-landing", f"{tmp_root}/ga4-staging"
    first = DAYS[0]
    land(spark, events, landing, first, [first - dt.timedelta(days=k) for k in range(1, 26)])
    runs = [staging_load.load(spark, landing, out, first)]
    for before, day in zip(DAYS, DAYS[1:]):
        days = [before + dt.timedelta(days=k) for k in range((day - before).days)]
        if day == DAYS[2]:
            days.append(day - dt.timedelta(days=2))
        land(spark, events, landing, day, days)
        runs.append(staging_load.load(spark, landing, out, day))
    return events, landing, out, runs


def test_daily_runs_equal_one_full_run(spark, loaded):
    events, _, out, _ = loaded
    raw = fixtures.raw_ga4_events(events, DAYS[-1])
    union = staging.stg_events_union(staging.stg_events_daily(raw, DAYS[-1]), staging.stg_events_intraday(raw, DAYS[-1]))
    want = staging.stg_events(union)
    got = staging_load.events_view(spark, out)
    assert got.columns == want.columns
    assert want.where("next_level_id is not null").count() > 50
    patched = spark.read.parquet(f"{out}/patches").where("user_pseudo_id is not null").count()
    assert patched > 5  # runs that were open at the end of a day
    assert rows(got) == rows(want)


def test_only_changed_shards_of_the_look_back_are_opened(loaded):
    _, _, _, runs = loaded
    name = lambda d: d.strftime("%Y%m%d")
    assert len(runs[0].opened) == 26 and runs[1].start == DAYS[1] - dt.timedelta(days=2)
    assert runs[1].opened == [name(DAYS[0]), f"intraday_{name(DAYS[1])}"] and runs[1].unchanged == [name(DAYS[1] - dt.timedelta(days=2))]
    assert runs[2].opened == [name(DAYS[0]), name(DAYS[1]), f"intraday_{name(DAYS[2])}"] and not runs[2].unchanged
    assert runs[3].start == DAYS[2] - dt.timedelta(days=1)  # a missed day: from the last stored state on


def test_a_repeated_run_opens_the_snapshot_only_and_leaves_earlier_days_alone(spark, loaded):
    _, landing, out, _ = loaded

    def files():
        return {os.path.join(p, f): os.path.getmtime(os.path.join(p, f)) for p, _, fs in os.walk(f"{out}/events") for f in fs if f.endswith(".parquet")}
    before, content = files(), rows(staging_load.events_view(spark, out))
    again = staging_load.load(spark, landing, out, DAYS[-1])
    assert again.opened == [DAYS[-1].strftime("intraday_%Y%m%d")]
    after = files()
    changed = {f.split("event_date=")[1][:10] for f in set(before.items()) ^ set(after.items()) for f in f[:1]}
    assert changed and min(changed) >= str(DAYS[-1] - dt.timedelta(days=2))
    assert rows(staging_load.events_view(spark, out)) == content


def test_a_full_load_gives_the_same_view(spark, loaded, tmp_root):
    events, landing, out, _ = loaded
    other = f"{tmp_root}/ga4-staging-full"
    staging_load.load(spark, landing, other, DAYS[-1], full=True)
    assert rows(staging_load.events_view(spark, other)) == rows(staging_load.events_view(spark, out))


def test_nothing_landed(spark, tmp_root):
    got = staging_load.load(spark, f"{tmp_root}/no-landing", f"{tmp_root}/no-staging", DAYS[0])
    assert got.opened == [] and staging_load.children(spark, f"{tmp_root}/no-staging") == []
