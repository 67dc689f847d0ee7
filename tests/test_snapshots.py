"""Snapshots are seen whole: half-landed ones never, a replaced day at once, and failed writes can be repeated."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from playmart.operators.staging import flatten_events, tracked_event_filter
from playmart.plans.warehouse import Warehouse
from playmart.sources import snapshots
from playmart.streaming import events_stream


@pytest.fixture(scope="module")
def day(spark, sf_dir, tmp_root):
    w = Warehouse(spark, sf_dir)
    path = f"{tmp_root}/snapshot-source"
    w.raw_events.where("table_suffix = 'intraday_20240130' and event_date = '20240130'").write.parquet(path)
    return w, spark.read.schema(w.raw_events.schema).parquet(path)


def rows(df):
    return sorted(map(str, df.collect()))


def flat(raw):
    return rows(flatten_events(tracked_event_filter(raw)))


def test_a_half_landed_newest_snapshot_is_not_taken_and_a_reader_keeps_its_rows(spark, day, tmp_root):
    w, today = day
    landing, table = f"{tmp_root}/half-landing", f"{tmp_root}/half-table"
    run = lambda: events_stream.stream_snapshot_replace(spark, landing, w.raw_events.schema, table, f"{tmp_root}/half-c", w.as_of)
    first = today.where(F.col("event_timestamp") % 7 != 0)
    events_stream.land_snapshot(first, landing, "2024-01-30T12:00")
    run()
    read = lambda: events_stream.read_events_table(spark, table)
    reader = read()  # chosen now, read later
    assert rows(read()) == flat(first) != flat(today)
    # a newer landing breaks off: some files are there, the marker is not
    (today.limit(5).withColumn("snapshot_ts", F.lit("2024-01-30T18:00")).write.mode("append")
     .partitionBy("event_date", "snapshot_ts").parquet(landing))
    run()
    assert rows(read()) == flat(first)
    # the landing is repeated in full: its leftovers are replaced, not added to
    events_stream.land_snapshot(today, landing, "2024-01-30T18:00")
    run()
    assert rows(read()) == flat(today)
    assert rows(reader) == flat(first)
    assert snapshots.retire(spark, table, "event_date") == 1
    assert rows(read()) == flat(today) and snapshots.published(spark, table) == {"2024-01-30": "2024-01-30T18:00"}
    late = today.limit(3)
    events_stream.land_snapshot(late, landing, "2024-01-30T15:00")  # an older one that lands late changes nothing
    run()
    assert rows(read()) == flat(today)


def test_a_write_that_breaks_off_leaves_the_day_as_it_was(spark, day, tmp_root):
    _, today = day
    path = f"{tmp_root}/broken"
    one = today.select("event_date", "event_timestamp")
    snapshots.publish(one.limit(10), path, "event_date", {"20240130": "1"})
    broken = one.withColumn("event_timestamp", F.when(F.col("event_timestamp") > 0, F.raise_error(F.lit("lost"))).cast("long"))
    with pytest.raises(Exception, match="lost"):
        snapshots.publish(broken, path, "event_date", {"20240130": "2"})
    read = lambda: snapshots.read_published(spark, path, "event_date", one.schema)
    assert read().count() == 10 and snapshots.published(spark, path) == {"20240130": "1"}
    assert snapshots.publish(one, path, "event_date", {"20240130": "2"}) == {"20240130": "2"}
    assert rows(read()) == rows(one)


def test_published_snapshots_are_not_written_again_and_an_empty_day_is_empty(spark, tmp_root):
    path = f"{tmp_root}/empty-days"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "d string, x int")
    assert snapshots.publish(df, path, "d", {"a": "1", "b": "1"}) == {"a": "1", "b": "1"}
    files = {f: os.path.getmtime(os.path.join(p, f)) for p, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert snapshots.publish(df, path, "d", {"a": "1"}) == {}
    assert files == {f: os.path.getmtime(os.path.join(p, f)) for p, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    snapshots.publish(df.where("d = 'x'"), path, "d", {"b": "2"})  # the newest snapshot of b has no rows
    assert rows(snapshots.read_published(spark, path, "d", df.schema)) == ["Row(d='a', x=1)"]
    assert snapshots.read_published(spark, f"{tmp_root}/none", "d", df.schema).count() == 0


def test_days_and_versions_with_special_characters(spark, tmp_root):
    path = f"{tmp_root}/special"
    df = spark.createDataFrame([("a/b@c", 1)], "d string, x int")
    snapshots.publish(df, path, "d", {"a/b@c": "2024-01-30 18:00:00+02:00"})
    assert snapshots.published(spark, path) == {"a/b@c": "2024-01-30 18:00:00+02:00"}
    assert rows(snapshots.read_published(spark, path, "d", df.schema)) == ["Row(d='a/b@c', x=1)"]
    snapshots.publish(df.withColumn("x", F.lit(2)), path, "d", {"a/b@c": "2024-01-30 19:00:00+02:00"})
    assert rows(snapshots.read_published(spark, path, "d", df.schema)) == ["Row(d='a/b@c', x=2)"]
    assert snapshots.retire(spark, path, "d") == 1 and len(snapshots.published(spark, path)) == 1
