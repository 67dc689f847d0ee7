"""Segmented per-user scans equal the plain single-window versions."""

from __future__ import annotations

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from playmart.functions.scans import (dense_rank_by_day, level_runs, record_steps, segmented_fill, segmented_lag,
                                      total_order)

T0 = dt.datetime(2024, 1, 1)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "user_pseudo_id string, event_timestamp timestamp_ntz, level_id bigint")


def test_runs_micro_frame(spark):
    # one user, levels NULL, A, A, B, A, NULL spread over several hours (segments)
    A, B = 60001, 60002
    lv = [None, A, A, B, A, None]
    rows = [("u1", T0 + dt.timedelta(minutes=50 * i), v) for i, v in enumerate(lv)]
    out = level_runs(_frame(spark, rows)).orderBy("event_timestamp").collect()
    assert [r.level_run_id for r in out] == [0, 1, 1, 2, 3, 3]
    assert [r.level_id for r in out] == [None, A, A, B, A, A]
    from playmart.operators.staging import level_neighbors
    nb = {r.level_run_id: (r.previous_level_id, r.next_level_id)
          for r in level_neighbors(level_runs(_frame(spark, rows))).collect()}
    prev = [nb[r][0] for r in (0, 1, 1, 2, 3, 3)]
    nxt = [nb[r][1] for r in (0, 1, 1, 2, 3, 3)]
    assert prev == [None, None, None, A, B, B]
    assert nxt == [A, B, B, A, None, None]


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 600), st.one_of(st.none(), st.integers(1, 4))),
    min_size=1, max_size=60)  # rows may share a timestamp, also at the edge of an hour


def _rows(raw):
    return [(u, T0 + dt.timedelta(minutes=10 * m), v) for u, m, v in raw]


def _running_max_by_steps(df):
    """Every row looks up the one step that is valid at its moment."""
    s = record_steps(df, ["user_pseudo_id"], "event_timestamp", "level_id").withColumnsRenamed(
        {"user_pseudo_id": "_u", "level_id": "mx"})
    at = F.col("event_timestamp")
    return df.join(s, (F.col("user_pseudo_id") == F.col("_u")) & (F.col("_from") <= at)
                   & (F.col("_to").isNull() | (at < F.col("_to"))), "left")


@settings(max_examples=8, deadline=None)
@given(rows_strategy)
def test_segmented_equals_plain_window(spark, raw):
    df = _frame(spark, _rows(raw))
    w = Window.partitionBy("user_pseudo_id").orderBy(total_order(df, "event_timestamp"))
    wm = Window.partitionBy("user_pseudo_id").orderBy("event_timestamp")
    plain = df.select(
        "user_pseudo_id", "event_timestamp",
        F.last("level_id", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("p"),
        F.first("level_id", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("n"),
        F.lag("event_timestamp").over(w).alias("lag"),
        F.max("level_id").over(wm.rangeBetween(Window.unboundedPreceding, 0)).alias("mx"))
    base = ["user_pseudo_id", "event_timestamp"]
    for seg, cols in ((segmented_fill(df, "level_id", prev_out="p", next_out="n"), ["p", "n"]),
                      (segmented_lag(df, "event_timestamp", "lag"), ["lag"]),
                      (_running_max_by_steps(df), ["mx"])):
        cols = base + cols
        assert sorted(map(str, plain.select(cols).collect())) == sorted(map(str, seg.select(cols).collect()))


@settings(max_examples=12, deadline=None)
@given(rows_strategy)
def test_level_runs_equals_plain_window(spark, raw):
    df = _frame(spark, _rows(raw))
    w = Window.partitionBy("user_pseudo_id").orderBy(total_order(df, "event_timestamp"))
    f = df.withColumn("level_id", F.last("level_id", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    f = f.withColumn("s", F.when(F.col("level_id").eqNullSafe(F.lag("level_id").over(w)), 0).otherwise(1))
    f = f.withColumn("level_run_id", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    wr = Window.partitionBy("user_pseudo_id").orderBy("level_run_id")
    runs = f.select("user_pseudo_id", "level_run_id", "level_id").distinct()
    assert runs.count() == runs.select("user_pseudo_id", "level_run_id").distinct().count()
    runs = runs.select("user_pseudo_id", "level_run_id", F.lag("level_id").over(wr).alias("previous_level_id"),
                       F.lead("level_id").over(wr).alias("next_level_id"))
    plain = f.drop("s").join(runs, ["user_pseudo_id", "level_run_id"])
    cols = ["user_pseudo_id", "event_timestamp", "level_id", "level_run_id", "previous_level_id", "next_level_id"]
    got = level_runs(df).select(cols).collect()
    assert sorted(map(str, plain.select(cols).collect())) == sorted(map(str, got))


def test_ties_across_an_hour_edge(spark):
    """Levels tied at the first moment of a segment: every run holds one level, no run is its own neighbour."""
    edge = T0 + dt.timedelta(hours=1)
    for tied in ([2, 1], [1, 2], [2, 2, 1]):
        rows = [("u", edge - dt.timedelta(seconds=1), 1), *(("u", edge, v) for v in tied)]
        out = level_runs(_frame(spark, rows)).collect()
        by_run = {}
        for r in out:
            by_run.setdefault(r.level_run_id, set()).add((r.level_id, r.previous_level_id, r.next_level_id))
        assert all(len(x) == 1 for x in by_run.values())
        assert all(lv not in (p, n) for x in by_run.values() for lv, p, n in x)


def test_dense_rank_by_day(spark):
    rnd = random.Random(3)
    rows = [("u%d" % rnd.randint(0, 3), dt.date(2024, 1, rnd.randint(1, 9))) for _ in range(80)]
    df = spark.createDataFrame(rows, "user_pseudo_id string, event_date date")
    w = Window.partitionBy("user_pseudo_id").orderBy("event_date")
    plain = df.withColumn("active_day", F.dense_rank().over(w).cast("bigint"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dense_rank_by_day(df).collect()))


@settings(max_examples=10, deadline=None)
@given(rows_strategy)
def test_segmented_row_number_equals_plain_window(spark, raw):
    from playmart.functions.scans import segmented_row_number
    df = _frame(spark, _rows(raw)).select("user_pseudo_id", "event_timestamp")
    w = Window.partitionBy("user_pseudo_id").orderBy("event_timestamp")
    plain = df.withColumn("rn", F.row_number().over(w).cast("bigint"))  # ties: equal rows, any order
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, segmented_row_number(df, "rn").collect()))


def test_wide_rows_never_shuffled_by_user_alone(spark, sf_dir):
    """Plan property behind the hot-player design: in stg_events the wide rows are exchanged only
    on (user, segment); exchanges keyed by the user alone carry narrow summary rows."""
    from playmart.operators import staging
    from playmart.plans.warehouse import Warehouse
    w = Warehouse(spark, sf_dir)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        union = spark.createDataFrame([], w.stg_events_union.schema)
        plan = staging.stg_events(union)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")

    def walk(n, acc):
        acc.append(n)
        it = n.children().iterator()
        while it.hasNext():
            walk(it.next(), acc)
        return acc

    exchanges = [n for n in walk(plan, []) if n.nodeName().startswith("Exchange")]
    wide = [n for n in exchanges if n.output().size() > 20]
    assert len(wide) == 1
    assert "_seg" in wide[0].outputPartitioning().toString()


def test_a_hot_hour_is_cut_by_count(spark):
    """One user's hour with ties and one moment of a third of its rows: pieces stay small, results do not change."""
    from playmart.functions.scans import segmented_row_number, with_segments
    rnd = random.Random(5)
    rows = [("hot", T0 + dt.timedelta(seconds=rnd.randrange(600)), rnd.choice([None, None, 1, 2])) for _ in range(1500)]
    rows += [("hot", T0 + dt.timedelta(seconds=300), rnd.choice([None, 1, 2, 3])) for _ in range(700)]
    rows += [("cold", T0 + dt.timedelta(minutes=k), k % 3) for k in range(40)]
    df = _frame(spark, rows).withColumn("event_name", F.concat(F.lit("e"), F.monotonically_increasing_id() % 3)) \
        .withColumn("n", F.monotonically_increasing_id())
    seg = with_segments(df, ["user_pseudo_id"], "event_timestamp", rows=100)
    sizes = seg.groupBy("user_pseudo_id", "_seg").count().collect()
    assert max(r["count"] for r in sizes) < 250 and sum(r["count"] for r in sizes) == len(rows)
    assert len({r._seg.at for r in sizes if r.user_pseudo_id == "cold"}) == len([r for r in sizes if r.user_pseudo_id == "cold"])
    # segments are ordered as the rows are
    w = Window.partitionBy("user_pseudo_id").orderBy("_ord")
    assert seg.withColumn("before", F.lag("_seg").over(w)).where("before > _seg").count() == 0
    cols = ["n", "level_id", "level_run_id", "previous_level_id", "next_level_id"]
    assert sorted(map(str, level_runs(df, rows=100).select(cols).collect())) == sorted(map(str, level_runs(df).select(cols).collect()))
    cols = ["n", "p", "q"]
    cut, plain = (segmented_fill(df, "level_id", prev_out="p", next_out="q", rows=r).select(cols).collect() for r in (100, None))
    assert sorted(map(str, cut)) == sorted(map(str, plain))
    cut, plain = (segmented_row_number(df, "rn", rows=r).select("n", "rn").collect() for r in (100, None))
    assert sorted(map(str, cut)) == sorted(map(str, plain))
