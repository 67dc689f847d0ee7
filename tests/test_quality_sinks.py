"""Data-quality checks find planted violations; sinks are idempotent and schema-evolving."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from playmart.operators import quality as q
from playmart.sources import sinks

AS_OF = dt.date(2024, 1, 30)


def _fail(df):
    return df.collect()[0]["failures"]


def test_column_checks_find_planted_rows(spark):
    df = spark.createDataFrame([(1, "mobile", 0.5, "a"), (None, "phablet", -1.0, "a"), (3, None, None, "b")],
                               "id int, cat string, rate double, k string")
    assert _fail(q.dq_not_null(df, "t", "id")) == 1
    assert _fail(q.dq_not_null(df, "t", "id", where="k = 'b'")) == 0
    assert _fail(q.dq_accepted_values(df, "t", "cat", ["mobile", "tablet"])) == 1   # NULL passes
    assert _fail(q.dq_accepted_range(df, "t", "rate", 0, 1)) == 1                   # NULL passes
    assert _fail(q.dq_unique_grain(df, "t", ["k"])) == 1
    batch = q.table_checks(df, "t", [q.not_null_check("id"), q.accepted_values_check("cat", ["mobile"]),
                                     q.accepted_range_check("rate", 0, 1)])
    assert [r.failures for r in batch.collect()] == [1, 1, 1]


def test_unique_grain_null_is_a_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 1)], "step_num int, t int")
    assert _fail(q.dq_unique_grain(df, "t", ["step_num", "t"])) == 1


def test_freshness_levels(spark):
    mk = lambda d: spark.createDataFrame([(d,)], "day date")
    assert q.dq_source_freshness(mk(AS_OF), "t", "day", AS_OF).collect()[0].status == "pass"
    assert q.dq_source_freshness(mk(AS_OF - dt.timedelta(days=2)), "t", "day", AS_OF).collect()[0].status == "warn"
    assert q.dq_source_freshness(mk(AS_OF - dt.timedelta(days=4)), "t", "day", AS_OF).collect()[0].status == "error"


def test_business_rules_find_planted_rows(spark):
    ua = spark.createDataFrame([(AS_OF + dt.timedelta(days=1), -5.0, 1.0)], "date date, spend double, revenue double")
    iap = spark.createDataFrame([(AS_OF, "x", "v", "spender", 10, 5.0, 0.4)],
                                "date date, geo_country string, app_version string, spender_segment string, "
                                "dau bigint, iap_revenue double, arpdau_iap double")
    ltv = spark.createDataFrame([(AS_OF - dt.timedelta(days=1), 1, 0.0)],
                                "cohort_date date, days_since_install bigint, iap_revenue double")
    assert q.dq_no_future_dates({"ua": (ua, "date")}, AS_OF).count() == 1
    assert q.dq_no_negative_revenue(ua, iap, ltv).count() == 1
    assert q.dq_arpdau_consistent(iap).count() == 1
    assert q.dq_ltv_elapsed(ltv, AS_OF).count() == 1
    summary = q.dq_summary([q.rows_as_summary(q.dq_ltv_elapsed(ltv, AS_OF), "dq_ltv_elapsed", "ltv")])
    with pytest.raises(AssertionError):
        q.assert_clean(summary)


def test_clean_data_has_no_error_failures(spark, sf_dir):
    import __spark_entry__ as entry
    summary = entry.queries()["dq_summary"](spark, sf_dir)
    q.assert_clean(summary)


def _read(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("d", "v").collect()))


def test_insert_overwrite_is_partition_scoped_and_idempotent(spark, tmp_root):
    path = os.path.join(tmp_root, "k3")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    first = spark.createDataFrame([(d1, 1), (d2, 2), (d3, 3)], "d date, v int")
    sinks.write_table(first, path, partition_by=("d",))
    again = spark.createDataFrame([(d2, 20)], "d date, v int")
    sinks.insert_overwrite_partitions(again, path, ["d"])
    once = _read(spark, path)
    assert once == [(d1, 1), (d2, 20), (d3, 3)]
    sinks.insert_overwrite_partitions(again, path, ["d"])
    assert _read(spark, path) == once
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_append_new_columns_is_idempotent_and_reads_null_for_old_rows(spark, tmp_root):
    path = os.path.join(tmp_root, "k6")
    spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, v int").write.partitionBy("d").parquet(path)
    new = spark.createDataFrame([(dt.date(2024, 1, 2), 2, 9.5)], "d date, v int, extra double")
    for _ in range(2):
        sinks.append_new_columns(new, path, ["d"])
        rows = sorted((r.v, r.extra) for r in sinks.read_evolving(spark, path, new.schema).collect())
        assert rows == [(1, None), (2, 9.5)]


def test_two_writers_in_one_session(spark, tmp_root):
    """A full rebuild and a partition load at the same time: neither changes the other's mode."""
    from concurrent.futures import ThreadPoolExecutor
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    base = spark.createDataFrame([(d, 0) for d in days], "d date, v int")
    a, b = (os.path.join(tmp_root, f"writers-{k}") for k in "ab")
    for p in (a, b):
        sinks.write_table(base, p, partition_by=("d",))
    part = spark.createDataFrame([(days[0], 7)], "d date, v int")
    with ThreadPoolExecutor(4) as pool:
        for _ in range(3):
            jobs = [pool.submit(sinks.insert_overwrite_partitions, part, a, ["d"]),
                    pool.submit(sinks.write_table, base, b, ("d",))]
            for j in jobs:
                j.result()
    assert _read(spark, a) == [(days[0], 7), *((d, 0) for d in days[1:])]
    assert _read(spark, b) == [(d, 0) for d in days]


def test_incremental_window(spark):
    df = spark.createDataFrame([(AS_OF - dt.timedelta(days=k),) for k in range(30)], "date date")
    assert sinks.incremental_window(df, "date", AS_OF, 14, True).count() == 15
    assert sinks.incremental_window(df, "date", AS_OF, 14, False).count() == 30
    assert F is not None


def test_daily_run_full_then_incremental_is_stable(spark, sf_dir, tmp_root):
    """A full build followed by an incremental run leaves the marts where incremental = full holds
    (Q16) exactly as a fresh full build; the data-quality gate passes on the written marts."""
    from playmart.plans.daily import run_daily
    from tools.compare import rows_key  # floats compared at 6 decimals: sums may change order
    out = os.path.join(tmp_root, "daily")
    paths = run_daily(spark, sf_dir, out, full=True, database="daily_build")

    def rows(p):
        df = spark.read.parquet(p)
        return rows_key([tuple(r[c] for c in sorted(df.columns)) for r in df.collect()])

    stable = ("ua_performance_daily", "engagement_daily", "iap_arpdau_daily",
              "creative_performance_daily", "ua_funnel_daily", "tutorial_funnel_daily")
    before = {k: rows(paths[k]) for k in stable}
    run_daily(spark, sf_dir, out, full=False, database="daily_build")
    assert set(sinks.catalog_tables(spark, "daily_build")) == set(paths)
    assert spark.table("daily_build.ua_funnel_daily").count() == len(before["ua_funnel_daily"])
    for k in stable:
        assert rows(paths[k]) == before[k], k


def test_row_counts_follow_the_catalog(spark, tmp_root):
    """A registered table has its row without a list of names, later partitions are taken up, views and dropped
    names are not counted, an empty table counts nothing."""
    db, path = "counted_tables", os.path.join(tmp_root, "counted")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_root, 'counted_db')}'")
    df = spark.createDataFrame([(1, AS_OF), (2, AS_OF), (3, AS_OF - dt.timedelta(days=30))], "n int, date date")
    counts = lambda: {(r.table_name, r.day): r.row_count for r in q.row_counts_by_day(
        sinks.catalog_tables(spark, db), AS_OF).collect()}
    sinks.write_table(df, path, partition_by=("date",))
    sinks.register_table(spark, db, "mart", path, df.schema, ("date",))
    sinks.write_table(df.drop("date"), path + "_sheet")
    sinks.register_table(spark, db, "sheet", path + "_sheet", df.drop("date").schema)
    sinks.write_table(df.where("n > 9"), path + "_none", partition_by=("date",))
    sinks.register_table(spark, db, "nothing", path + "_none", df.schema, ("date",))
    spark.sql(f"CREATE OR REPLACE VIEW {db}.some_view AS SELECT 1 AS n")
    assert counts() == {("mart", AS_OF): 2, ("sheet", None): 3}
    day = AS_OF - dt.timedelta(days=1)
    sinks.insert_overwrite_partitions(spark.createDataFrame([(4, day)], df.schema), path, ["date"])
    sinks.register_table(spark, db, "mart", path, df.schema, ("date",))
    assert counts() == {("mart", AS_OF): 2, ("mart", day): 1, ("sheet", None): 3}
    spark.sql(f"DROP TABLE {db}.mart")
    assert counts() == {("sheet", None): 3} and spark.read.parquet(path).count() == 4
