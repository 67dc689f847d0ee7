"""Differential test: every registered query against its DuckDB oracle on sf0.001, plus the
streaming loads against the batch intraday model and a replay of the replace stream."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tools.compare import rows_key

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_every_query_is_registered_with_an_oracle_or_marked():
    missing = sorted(k for k in set(QUERIES) - set(ORACLE) if not re.match(r"op\d+_|pipeline$", k))
    assert missing == ["session_depth_daily_approx"]  # approximate percentiles: rows-only


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    sdf = QUERIES[key](spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    order = sorted(scols)
    a = rows_key([tuple(r[scols.index(c)] for c in order) for r in srows])
    b = rows_key([tuple(r[dcols.index(c)] for c in order) for r in drows])
    assert a == b


def test_approx_percentiles_close_to_exact(spark, sf_dir):
    exact = {tuple(r[:4]): r for r in QUERIES["session_depth_daily"](spark, sf_dir).collect()}
    approx = QUERIES["session_depth_daily_approx"](spark, sf_dir).collect()
    assert len(approx) == len(exact)
    for r in approx:
        e = exact[tuple(r[:4])]
        assert r.sessions == e.sessions and r.avg_events_per_session == e.avg_events_per_session


@pytest.mark.parametrize("accuracy", [10000, 20])
def test_approx_percentiles_keep_their_rank_error(spark, accuracy):
    """Of every group, metric and fraction p: the answer is a value of the group, and the share of rows it covers
    brackets p within 1 / accuracy (rank error of the sketch) of the exact rank."""
    import bisect
    import datetime as dt
    import random
    from playmart.operators import marts
    rng = random.Random(11)
    sizes = {"IOS": 4000, "ANDROID": 900, "WEB": 3}
    rows = [(f"u{rng.randrange(400)}", i, dt.date(2024, 1, 5), p, "0.1.8", "Germany",
             int(rng.paretovariate(0.7)), rng.randrange(100000), rng.randrange(6))
            for p, n in sizes.items() for i in range(n)]
    sess = spark.createDataFrame(rows, "user_pseudo_id string, ga_session_id bigint, session_date date, platform string, "
                                 "app_version string, geo_country string, events_in_session bigint, "
                                 "duration_seconds bigint, levels_in_session bigint").cache()
    days = {p: [] for p in sizes}
    for r in marts.session_user_days(sess).collect():
        days[r.platform].append(r.sessions_in_day)
    for r in marts.session_depth_daily(None, accuracy=accuracy, sess=sess).collect():
        of = lambda i: sorted(x[i] for x in rows if x[3] == r.platform)  # noqa: B023, E731
        values = {"events_per_session": of(6), "duration_seconds": of(7), "levels_per_session": of(8),
                  "sessions_per_user": sorted(days[r.platform])}
        for metric, v in values.items():
            for p, name in zip(marts.PERCENTILES, marts.PCT_NAMES):
                got, slack = r[f"{name}_{metric}"], len(v) / accuracy + 1
                assert got in v
                below, upto = bisect.bisect_left(v, got), bisect.bisect_right(v, got)
                assert below - slack <= p * len(v) <= upto + slack, (r.platform, metric, name, accuracy)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "days_since_install" in df.columns


def test_newest_snapshot_replaces_the_day(spark, sf_dir, tmp_root):
    """Two full snapshots, the second with changed and removed rows: the table is exactly the second,
    also after a replay of every batch, and other days' rows are not taken."""
    import os
    from pyspark.sql import functions as F
    from playmart.operators.staging import flatten_events, tracked_event_filter
    from playmart.plans.warehouse import Warehouse
    from playmart.streaming import events_stream
    w = Warehouse(spark, sf_dir)
    landing, table = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "table")
    snap = w.raw_events.where("table_suffix = 'intraday_20240130'")
    other = w.raw_events.where("event_date = '20240129'")
    second = (snap.where(F.col("event_timestamp") % 5 != 0)
              .withColumn("user_pseudo_id", F.when(F.col("event_timestamp") % 3 == 0, F.lit("changed")).otherwise(F.col("user_pseudo_id"))))
    want = sorted(map(str, flatten_events(tracked_event_filter(second)).collect()))
    run = lambda c: events_stream.stream_snapshot_replace(
        spark, landing, w.raw_events.schema, table, os.path.join(tmp_root, c), w.as_of)
    got = lambda: sorted(map(str, events_stream.read_events_table(spark, table).collect()))
    events_stream.land_snapshot(snap, landing, "2024-01-30T12")
    events_stream.land_snapshot(other, landing, "2024-01-30T12")
    run("c1")
    assert len(got()) == w.stg_events_intraday.count()
    events_stream.land_snapshot(second, landing, "2024-01-30T18")
    run("c1")
    assert got() == want and len(want) < w.stg_events_intraday.count()
    run("c2")  # a fresh checkpoint replays every batch
    assert got() == want


def test_snapshot_read_opens_the_newest_folder_of_the_day(spark, sf_dir, tmp_root):
    import os
    from playmart.plans.warehouse import Warehouse
    from playmart.sources import snapshots
    from playmart.streaming import events_stream
    w = Warehouse(spark, sf_dir)
    landing = os.path.join(tmp_root, "pruned")
    for ts in ("1", "2"):
        events_stream.land_snapshot(w.raw_events.where("event_date >= '20240129'"), landing, ts)
    df = snapshots.read_published(spark, landing, "event_date", w.raw_events.schema, ["20240130"])
    opened = {f.split("pruned/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}
    assert opened == {"event_date=20240130/snapshot_ts=2"}
    assert df.schema.names == w.raw_events.schema.names
