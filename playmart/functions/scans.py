"""Skew-safe ordered scans per user.

The reference fills gaps with windows ``PARTITION BY user ORDER BY ts``. On a cluster one player
(a bot, a load-test account) can own a large share of all events, and a plain window puts all of
that user's rows into one task. These helpers compute the same values as a two-level scan:

1. a window over ``(user, segment)`` where the segment is a time bucket of the ordering column
   (so segments are ordered the same way as rows); a bucket of more than ``SEGMENT_ROWS`` rows of one user
   is cut further by count (``with_segments``), and
2. a per-user window over one summary row per segment (first/last non-null value, counts), which
   is tiny compared with the events, joined back on ``(user, segment)``.

The result equals the single-window version; the differential tests check it against the
plain-window SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_UNIT = "hour"


#: A user's time bucket with more rows is cut into pieces of about this many.
SEGMENT_ROWS = 1_000_000
#: Most pieces of one bucket, and how many edges are searched at a time.
PIECES, EDGE_BLOCK = 1024, 32


def total_order(df: DataFrame, ts_col: str, over: list[str] | None = None) -> Column:
    """One total order of rows: the timestamp, then the event name where there is one, then a hash of
    the whole row (of the columns ``over``, if given). Every window and every first/last aggregate of a scan
    uses it, so rows with equal timestamps have the same order everywhere (rows equal in all columns are
    interchangeable)."""
    names = over or df.columns
    tie = [F.col("event_name")] if "event_name" in names else []
    return F.struct(F.col(ts_col), *tie, F.xxhash64(*(F.col(c) for c in names)).alias("_h"))


def with_segments(df: DataFrame, key_cols: list[str], ts_col: str, unit: str = SEGMENT_UNIT, rows: int | None = None,
                  over: list[str] | None = None) -> DataFrame:
    """Add ``_ord`` (``total_order``) and ``_seg``, a struct ordered like it whose field ``at`` is the time bucket.

    Buckets with more than ``rows`` rows of a key are found by a pre-aggregated count and cut at quantiles of the
    timestamp. A moment that is a quantile itself is a piece of its own, cut by event name and by the high bits of
    the row hash, so many rows with one timestamp are spread too. Edges are at most one per ``rows`` rows of the
    table, which bounds the broadcast; nothing is cut, and nothing but the count is read, where no bucket is hot.
    """
    rows = rows or SEGMENT_ROWS
    keys = [*key_cols, "_at"]
    d = df.withColumn("_ord", total_order(df, ts_col, over)).withColumn("_at", F.date_trunc(unit, F.col(ts_col)))
    d = d.withColumn("_us", F.unix_micros(F.col(ts_col).cast("timestamp")))
    narrow = d.select(*keys, "_us")
    hot = narrow.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows)
    step = F.greatest(F.lit(1), F.ceil(F.lit(PIECES) * rows / F.col("_n"))).cast("int")
    cuts = (narrow.join(F.broadcast(hot), keys).groupBy(*keys, "_n")
            .agg(F.percentile_approx("_us", [k / PIECES for k in range(1, PIECES)], 10 * PIECES).alias("_q"))
            .withColumn("_q", F.array_distinct(F.filter("_q", lambda x, k: (k + 1) % step == 0)))
            .withColumn("_lists", F.transform(F.sequence(F.lit(0), F.size("_q") - 1, F.lit(EDGE_BLOCK)),
                                              lambda k: F.slice("_q", k + 1, EDGE_BLOCK)))
            .withColumn("_tops", F.transform("_lists", lambda x: F.element_at(x, -1)))
            .select(*(F.col(k).alias(f"_c{k}") for k in keys), "_lists", "_tops"))
    same = [F.col(k) == F.col(f"_c{k}") for k in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    d = d.join(F.broadcast(cuts), on, "left")
    us = F.col("_us")
    block = F.size(F.filter("_tops", lambda x: x < us))
    here = F.coalesce(F.get("_lists", block), F.array().cast("array<long>"))
    edge = F.array_contains(here, us)
    piece = F.when(F.col("_tops").isNull(), 0).otherwise(
        2 * (block * EDGE_BLOCK + F.size(F.filter(here, lambda x: x < us))) + edge.cast("int"))
    cut = F.col("_tops").isNotNull() & edge
    name = F.when(cut, F.col("event_name")) if "event_name" in (over or df.columns) else F.lit(None).cast("string")
    part = F.when(cut, F.shiftright(F.col("_ord._h"), 56).cast("int"))
    d = d.withColumn("_seg", F.struct(F.col("_at").alias("at"), piece.alias("piece"), F.coalesce(name, F.lit("")).alias("name"),
                                      F.coalesce(part, F.lit(0)).alias("part")))
    return d.drop("_at", "_us", "_lists", "_tops", *(f"_c{k}" for k in keys))


def _first_last_nonnull(value_col: str):
    v = F.col(value_col)
    order = F.when(v.isNotNull(), F.col("_ord"))
    return F.min_by(v, order), F.max_by(v, order)


def segmented_fill(df: DataFrame, value_col: str, key_col: str = "user_pseudo_id",
                   ts_col: str = "event_timestamp", prev_out: str = "previous_level_id",
                   next_out: str | None = "next_level_id", unit: str = SEGMENT_UNIT, rows: int | None = None) -> DataFrame:
    """Add ``prev_out`` = last non-null ``value_col`` at or before the row and (optionally)
    ``next_out`` = first non-null ``value_col`` at or after the row, per ``key_col`` in ``ts_col``
    order. Keys must be non-null (callers drop NULL users first)."""
    seg = "_seg"
    d = with_segments(df, [key_col], ts_col, unit, rows)
    w = Window.partitionBy(key_col, seg).orderBy("_ord")
    d = d.withColumn("_prev_local", F.last(value_col, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    if next_out:
        d = d.withColumn("_next_local", F.first(value_col, ignorenulls=True).over(
            w.rowsBetween(0, Window.unboundedFollowing)))
    first_v, last_v = _first_last_nonnull(value_col)
    summary = d.groupBy(key_col, seg).agg(first_v.alias("_seg_first"), last_v.alias("_seg_last"))
    wu = Window.partitionBy(key_col).orderBy(seg)
    summary = summary.withColumn("_carry_in", F.last("_seg_last", ignorenulls=True).over(
        wu.rowsBetween(Window.unboundedPreceding, -1)))
    cols = [key_col, seg, "_carry_in"]
    if next_out:
        summary = summary.withColumn("_carry_out", F.first("_seg_first", ignorenulls=True).over(
            wu.rowsBetween(1, Window.unboundedFollowing)))
        cols.append("_carry_out")
    d = d.join(summary.select(*cols), [key_col, seg], "left")
    d = d.withColumn(prev_out, F.coalesce(F.col("_prev_local"), F.col("_carry_in")))
    drop = ["_prev_local", "_carry_in", "_ord", seg]
    if next_out:
        d = d.withColumn(next_out, F.coalesce(F.col("_next_local"), F.col("_carry_out")))
        drop += ["_next_local", "_carry_out"]
    return d.drop(*drop)


def segmented_lag(df: DataFrame, col: str, out: str, key_col: str = "user_pseudo_id",
                  ts_col: str = "event_timestamp", unit: str = SEGMENT_UNIT, rows: int | None = None) -> DataFrame:
    """``out`` = value of ``col`` on the previous row of the same key in ``ts_col`` order.

    ``col`` must be non-decreasing with ``ts_col`` within a key (it is ``ts_col`` itself in use)."""
    seg = "_seg"
    d = with_segments(df, [key_col], ts_col, unit, rows)
    w = Window.partitionBy(key_col, seg).orderBy("_ord")
    d = d.withColumn("_lag_local", F.lag(col).over(w))
    summary = d.groupBy(key_col, seg).agg(F.max_by(F.col(col), F.col("_ord")).alias("_seg_last"))
    wu = Window.partitionBy(key_col).orderBy(seg)
    summary = summary.withColumn("_carry_in", F.lag("_seg_last").over(wu)).select(key_col, seg, "_carry_in")
    d = d.join(summary, [key_col, seg], "left")
    return d.withColumn(out, F.coalesce(F.col("_lag_local"), F.col("_carry_in"))).drop(
        "_lag_local", "_carry_in", "_ord", seg)


def level_runs(df: DataFrame, level_col: str = "level_id", key_col: str = "user_pseudo_id",
               ts_col: str = "event_timestamp", unit: str = SEGMENT_UNIT, rows: int | None = None,
               state: DataFrame | None = None, next_at: str | None = None, over: list[str] | None = None) -> DataFrame:
    """Forward-fill ``level_col`` (overwriting it), number the runs of equal filled values and add
    the levels of the neighbouring runs.

    Run ids start at 0 for rows before the first level and grow by one at each change
    (``IS DISTINCT FROM`` the previous row's filled value). Adds ``level_run_id``,
    ``previous_level_id`` and ``next_level_id``.

    One wide exchange on (key, segment): inside a segment one window gives the fill, the run number
    and the neighbours that lie in the segment. What crosses a segment's edge comes from one narrow
    row per segment: its first two and last two run levels and its number of runs.

    ``state`` (key, ``level_col``, ``previous_level_id``, ``level_run_id``; one row a key) is how each key stood
    before the first row; it joins the narrow rows only. ``next_at`` names a column for the time bucket in
    which the next run starts. ``over``: the columns that order rows with equal timestamps.
    """
    seg = "_seg"
    d = with_segments(df, [key_col], ts_col, unit, rows, over)
    w = Window.partitionBy(key_col, seg).orderBy("_ord")
    upto, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    ff = F.col("_ff")
    d = d.withColumn("_ff", F.last(level_col, ignorenulls=True).over(upto))
    d = d.withColumn("_before", F.lag("_ff").over(w))
    # a NULL fill (before the segment's first level) starts no run
    d = d.withColumn("_start", ff.isNotNull() & ~ff.eqNullSafe(F.col("_before")))
    d = d.withColumn("_run", F.sum(F.col("_start").cast("int")).over(upto))
    d = d.withColumn("_prev_local", F.last(F.when(F.col("_start"), F.col("_before")), ignorenulls=True).over(upto))
    d = d.withColumn("_next_local", F.first(F.when(F.col("_start"), ff), ignorenulls=True).over(after))

    level_of_run = lambda r: F.max(F.when(F.col("_start") & (F.col("_run") == r), ff))
    summary = d.groupBy(key_col, seg).agg(
        level_of_run(1).alias("_first"), level_of_run(2).alias("_second"), F.max("_run").alias("_n"),
        F.max_by("_ff", F.struct("_run", ff.isNotNull())).alias("_last"),
        F.max_by("_prev_local", F.struct("_run", ff.isNotNull())).alias("_last_but_one"))
    wu = Window.partitionBy(key_col).orderBy(seg)
    earlier = wu.rowsBetween(Window.unboundedPreceding, -1)
    later = wu.rowsBetween(1, Window.unboundedFollowing)
    if state is None:
        none = F.lit(None).cast(df.schema[level_col].dataType)
        summary = summary.withColumns({"_was": none, "_was_prev": none, "_was_run": F.lit(0)})
    else:
        summary = summary.join(state.select(key_col, F.col(level_col).alias("_was"), F.col("previous_level_id").alias("_was_prev"),
                                            F.col("level_run_id").alias("_was_run")), key_col, "left")
    summary = summary.withColumn("_carry", F.coalesce(F.last("_last", ignorenulls=True).over(earlier), "_was"))
    # the segment's first run goes on with the carried-in one when it has the same level
    summary = summary.withColumn("_continues", F.coalesce(F.col("_first") == F.col("_carry"), F.lit(False)))
    summary = summary.withColumn("_offset", F.coalesce(F.sum(F.col("_n") - F.col("_continues").cast("int")).over(earlier), F.lit(0))
                                 + F.coalesce("_was_run", F.lit(0)))
    # level before the one carried in: set where a segment ends in another run than it began with
    ended = F.when(F.col("_n") >= 2, F.col("_last_but_one")).when((F.col("_n") == 1) & ~F.col("_continues"), F.col("_carry"))
    summary = summary.withColumn("_carry_prev", F.coalesce(F.last(ended, ignorenulls=True).over(earlier), "_was_prev"))
    # first level in the segment that differs from the carried-in one, and the same of later segments
    summary = summary.withColumn("_change", F.when(F.col("_continues"), F.col("_second")).otherwise(F.col("_first")))
    change = F.when(F.col("_change").isNotNull(), F.struct(F.col("_change").alias("level"), F.col(seg)["at"].alias("at")))
    summary = summary.withColumn("_later", F.first(change, ignorenulls=True).over(later))
    summary = summary.withColumn("_carry_next", F.col("_later.level"))
    d = d.join(summary.select(key_col, seg, "_carry", "_continues", "_offset", "_carry_prev", "_change", "_carry_next", "_later"),
               [key_col, seg], "left")
    carried = ff.isNull()  # the row belongs to the run carried in
    first_run = F.col("_run") == 1
    run = F.col("_offset") + F.col("_run") - F.when(carried, 0).otherwise(F.col("_continues").cast("int"))
    previous = (F.when(carried | (first_run & F.col("_continues")), F.col("_carry_prev"))
                .when(first_run, F.col("_carry")).otherwise(F.col("_prev_local")))
    following = F.when(carried, F.coalesce("_change", "_carry_next")).otherwise(F.coalesce("_next_local", "_carry_next"))
    out = {level_col: F.coalesce(ff, F.col("_carry")), "level_run_id": run.cast("bigint"),
           "previous_level_id": previous, "next_level_id": following}
    if next_at:
        local = F.when(carried, F.col("_change")).otherwise(F.col("_next_local")).isNotNull()
        out[next_at] = F.when(local, F.col(seg)["at"]).otherwise(F.col("_later.at"))
    return d.withColumns(out).select(*df.columns, *(c for c in out if c not in df.columns))


def record_steps(df: DataFrame, keys: list[str], order_col: str, value_col: str) -> DataFrame:
    """The running maximum of ``value_col`` per key as a step function: (keys, value_col, ``_from``, ``_to``), one row
    per record high, valid from ``_from`` up to but not at ``_to`` (NULL: for good). Rows without value or order are
    left out; of rows tied in order the highest counts.

    A (key, value) counts from its first appearance only, so a partial aggregation leaves at most one row per
    distinct value before the window, however many rows a key has."""
    first = df.where(F.col(value_col).isNotNull() & F.col(order_col).isNotNull()).groupBy(*keys, value_col).agg(
        F.min(order_col).alias("_from"))
    w = Window.partitionBy(*keys).orderBy("_from", F.col(value_col).desc())
    before = F.max(value_col).over(w.rowsBetween(Window.unboundedPreceding, -1))
    highs = first.withColumn("_before", before).where(F.col("_before").isNull() | (F.col(value_col) > F.col("_before")))
    return highs.withColumn("_to", F.lead("_from").over(w)).drop("_before")


def dense_rank_by_day(df: DataFrame, key_col: str = "user_pseudo_id", day_col: str = "event_date",
                      out: str = "active_day") -> DataFrame:
    """``out`` = DENSE_RANK() OVER (PARTITION BY key ORDER BY day), 1-based, as BIGINT.

    Ranks are computed over the distinct (key, day) pairs, at most one row per active day, and
    joined back, so a user with many events per day never forms one large window partition."""
    days = df.select(key_col, day_col).distinct()
    w = Window.partitionBy(key_col).orderBy(day_col)
    ranked = days.withColumn(out, F.row_number().over(w).cast("bigint"))
    return df.join(ranked, [key_col, day_col], "left")


def segmented_row_number(df: DataFrame, out: str, key_col: str = "user_pseudo_id",
                         ts_col: str = "event_timestamp", unit: str = SEGMENT_UNIT, rows: int | None = None) -> DataFrame:
    """``out`` = ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts, total order) as BIGINT: local numbers per
    (key, segment) plus the count of the key's rows in earlier segments."""
    seg = "_seg"
    d = with_segments(df, [key_col], ts_col, unit, rows)
    w = Window.partitionBy(key_col, seg).orderBy("_ord")
    d = d.withColumn("_rn_local", F.row_number().over(w))
    summary = d.groupBy(key_col, seg).agg(F.count(F.lit(1)).alias("_n"))
    wu = Window.partitionBy(key_col).orderBy(seg)
    summary = summary.withColumn("_offset", F.coalesce(F.sum("_n").over(
        wu.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(key_col, seg, "_offset")
    d = d.join(summary, [key_col, seg], "left")
    return d.withColumn(out, (F.col("_offset") + F.col("_rn_local")).cast("bigint")).drop("_rn_local", "_offset", "_ord", seg)
