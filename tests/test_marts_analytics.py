"""Golden rows and hand-made micro-frames for marts and analytics (FIXTURES.md §5-6)."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from playmart.operators import analytics, marts

UA_SCHEMA = ("date date, app string, platform string, country string, installs bigint, paid_installs bigint, "
             "organic_installs bigint, spend double, revenue double, cohort_revenue double, ad_revenue double, "
             "impressions bigint, clicks bigint")
ENG_SCHEMA = ("date date, platform string, country string, dau bigint, new_users bigint, payers bigint, "
              "total_revenue double, iap_revenue double, sessions bigint, d1_retention double, "
              "d7_retention double, d30_retention double")
D1, D2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)


def test_overview_golden_rows(spark):
    ua = spark.createDataFrame([(D1, "game1", "ios", "US", 100, 60, 40, 200.0, 50.0, 400.0, 30.0, 1000, 200)], UA_SCHEMA)
    eng = spark.createDataFrame([
        (D1, "ios", "US", 500, 80, 25, 100.0, 60.0, 1200, 0.4, 0.2, 0.1),
        (D2, "android", "DE", 100, 20, 5, 40.0, 25.0, 300, 0.5, 0.3, 0.15)], ENG_SCHEMA)
    rows = {r.date: r for r in marts.overview_daily(ua, eng).collect()}
    m = rows[D1]
    assert (m.app, m.ecpi, m.roas, m.arpdau, m.arppu) == ("game1", 2.0, 2.0, 0.2, 2.4)
    assert (m.d1_retention, m.d7_retention, m.d30_retention) == (0.4, 0.2, 0.1)
    e = rows[D2]
    assert e.app is None and e.installs is None and e.spend is None and e.ecpi is None
    assert (e.arpdau, e.arppu, e.platform, e.country) == (0.4, 5.0, "android", "DE")


def test_overview_fans_engagement_out_per_app(spark):
    # Q7: two apps in one UA cell, one engagement cell -> engagement repeated on both rows
    ua = spark.createDataFrame([(D1, "a1", "ios", "US", 1, 1, 0, 1.0, 1.0, 1.0, 1.0, 1, 1),
                                (D1, "a2", "ios", "US", 1, 1, 0, 1.0, 1.0, 1.0, 1.0, 1, 1)], UA_SCHEMA)
    eng = spark.createDataFrame([(D1, "ios", "US", 500, 80, 25, 100.0, 60.0, 1200, 0.4, 0.2, 0.1)], ENG_SCHEMA)
    out = marts.overview_daily(ua, eng).collect()
    assert sorted(r.app for r in out) == ["a1", "a2"] and all(r.dau == 500 for r in out)


EV_SCHEMA = ("event_date date, event_timestamp timestamp_ntz, event_name string, user_pseudo_id string, "
             "geo_country string, app_version string, event_value_in_usd double, price_dollars double")


def _ev(spark, rows):
    return spark.createDataFrame(rows, EV_SCHEMA)


def test_cohort_ltv_null_geo_and_elapsed_days(spark):
    as_of = dt.date(2024, 1, 30)
    c = dt.date(2024, 1, 28)  # cohort two days before as_of -> only dsi 0 and 1
    ts = lambda d, h: dt.datetime.combine(d, dt.time(h))
    rows = [
        (c, ts(c, 1), "first_open", "u1", "Germany", "0.1.8", None, None),
        (c, ts(c, 2), "first_open", "u2", None, "0.1.8", None, None),          # Q13: NULL geo dropped
        (c, ts(c, 3), "iap_purchase", "u1", "Germany", "0.1.8", None, 2.5),
        (dt.date(2024, 1, 29), ts(dt.date(2024, 1, 29), 3), "in_app_purchase", "u1", "Germany", "0.1.8", 4.0, None),
    ]
    out = marts.cohort_ltv_daily(_ev(spark, rows), as_of).orderBy("days_since_install").collect()
    assert [r.days_since_install for r in out] == [0, 1]
    assert [r.cohort_size for r in out] == [1, 1]
    assert [r.iap_revenue for r in out] == [2.5, 4.0]
    assert all(r.geo_country == "Germany" for r in out)


UPG_SCHEMA = ("event_date date, event_timestamp timestamp_ntz, event_name string, user_pseudo_id string, "
              "app_version string, level_id bigint, staff_id bigint, staff_level bigint, object_id bigint, "
              "object_level bigint")


def test_upgrades_analysis_as_of_rules(spark):
    d = dt.date(2024, 1, 20)
    t = lambda m: dt.datetime(2024, 1, 20, 10, m)
    ev = spark.createDataFrame([
        (d, t(5), "staff_level_purchase", "u", "0.1.8", None, 110, 3, None, None),   # before the fail: counted
        (d, t(10), "level_failed", "u", "0.1.8", 60005, None, None, None, None),
        (d, t(20), "staff_level_purchase", "u", "0.1.8", None, 110, 5, None, None),   # after the fail: ignored
    ], UPG_SCHEMA)
    recs = spark.createDataFrame([(60004, 110, 2), (60005, 110, 1), (60006, 110, 9)],
                                 "level_id bigint, item_id bigint, upgrade_level bigint")
    out = analytics.upgrades_analysis(ev, recs).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.upgrade_level, r.recommended_upgrade_level, r.follow_recommendation) == (3, 2, "pass")


def test_upgrades_analysis_equals_brute_force(spark):
    # ties, missing items and levels, levels and items outside the sheet, one user with a third of the rows
    rng = random.Random(5)
    maybe = lambda v: None if rng.random() < 0.1 else v
    ev = []
    for _ in range(600):
        m = dt.datetime(2024, 1, 20, rng.randrange(3), rng.randrange(20))
        user, version = rng.choice(["hot", "a", "b", "c", "hot"]), rng.choice(["0.1.7", "0.1.8", "0.1.9"])
        kind = rng.choice(["level_failed", "staff_level_purchase", "object_level_purchase"])
        item, up = maybe(rng.choice([110, 111, 112, 500])), maybe(rng.randrange(1, 9))
        row = {"level_failed": (maybe(60000 + rng.randrange(8)), None, None, None, None),
               "staff_level_purchase": (None, item, up, None, None),
               "object_level_purchase": (None, None, None, item, up)}[kind]
        ev.append((m.date(), m, kind, user, version, *row))
    recs = [(60000 + rng.randrange(6), rng.choice([110, 111, 112, 113]), maybe(rng.randrange(1, 9))) for _ in range(25)]
    recs.append((60000, None, 3))
    bought = [(e[3], e[1], e[6] if e[6] is not None else e[8], e[7] if e[7] is not None else e[9])
              for e in ev if e[2] != "level_failed" and e[4] >= "0.1.8"]
    last = {}
    for e in ev:
        if e[2] == "level_failed" and e[4] >= "0.1.8":
            key = (e[4], e[3], e[5])
            last[key] = max(last.get(key, e[1]), e[1])
    expected = set()
    for (version, user, level), at in last.items():
        for item in {r[1] for r in recs if level in {x[0] for x in recs}} - {None}:
            own = [b[3] for b in bought if b[0] == user and b[1] <= at and b[2] == item and b[3] is not None]
            rec = [r[2] for r in recs if r[1] == item and r[0] <= level and r[2] is not None]
            if own and rec:
                expected.add((version, user, level, item, max(own), level, item, max(rec),
                              "pass" if max(own) >= max(rec) else "fail"))
    out = analytics.upgrades_analysis(spark.createDataFrame(ev, UPG_SCHEMA), spark.createDataFrame(
        recs, "level_id bigint, item_id bigint, upgrade_level bigint")).collect()
    assert len(out) == len(expected) > 20 and {tuple(r) for r in out} == expected


def test_upgrades_analysis_string_version_compare(spark):
    # Q12: '0.1.10' < '0.1.8' as strings, so its fails are excluded
    d = dt.date(2024, 1, 25)
    ev = spark.createDataFrame([
        (d, dt.datetime(2024, 1, 25, 1), "staff_level_purchase", "u", "0.1.10", None, 110, 3, None, None),
        (d, dt.datetime(2024, 1, 25, 2), "level_failed", "u", "0.1.10", 60005, None, None, None, None),
    ], UPG_SCHEMA)
    recs = spark.createDataFrame([(60005, 110, 1)], "level_id bigint, item_id bigint, upgrade_level bigint")
    assert analytics.upgrades_analysis(ev, recs).count() == 0


def test_level_attribution_coalesce_order(spark):
    rows = [("u", dt.datetime(2024, 1, 1, h), n, lv) for h, n, lv in
            [(0, "booster_used", None), (1, "level_started", 7), (2, "booster_used", None), (5, "level_started", 8)]]
    df = spark.createDataFrame(rows, "user_pseudo_id string, event_timestamp timestamp_ntz, event_name string, level_id bigint")
    got = [r.attributed_level for r in analytics.level_attribution(df).orderBy("event_timestamp").collect()]
    assert got == [7, 7, 7, 8]  # before the first level: next level; after: previous level
    got2 = [r.x for r in analytics.level_attribution(df, with_current=False, out="x").orderBy("event_timestamp").collect()]
    assert got2 == [7, 7, 7, 8]
    assert F is not None


def test_incremental_equals_full_inside_window(spark, sf_dir):
    # Q16: for P1, P2, P3, P5, P6, P10 the 14-day incremental rebuild equals the full model there
    from playmart.plans.warehouse import Warehouse
    w = Warehouse.shared(spark, sf_dir)
    cutoff = F.date_sub(F.lit(w.as_of), 14)
    cases = [
        (marts.ua_performance_daily, w.stg_adjust, "date"),
        (marts.engagement_daily, w.stg_unity, "date"),
        (marts.iap_arpdau_daily, w.stg_events, "date"),
        (marts.creative_performance_daily, w.stg_meta_ad, "date"),
        (marts.ua_funnel_daily, w.stg_adjust, "date"),
        (marts.tutorial_funnel_daily, w.stg_events, "date"),
    ]
    for fn, src, col in cases:
        full = fn(src, w.as_of).where(F.col(col) >= cutoff)
        inc = fn(src, w.as_of, incremental=True)
        assert inc.count() > 0
        assert full.exceptAll(inc).count() == 0 and inc.exceptAll(full).count() == 0, fn.__name__


def test_mart_invariants(spark, sf_dir):
    from playmart.plans.warehouse import Warehouse
    w = Warehouse.shared(spark, sf_dir)
    # LTV grid: every cohort cell has one row per fully elapsed day, at most 31
    ltv = marts.cohort_ltv_daily(w.stg_events, w.as_of)
    cells = ltv.groupBy("cohort_date", "geo_country", "app_version").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "expected", F.least(F.lit(31), F.datediff(F.lit(w.as_of), F.col("cohort_date"))))
    assert cells.where(F.col("n") != F.col("expected")).count() == 0
    # spend reconciles: the mart's total equals the staging total
    ua = marts.ua_performance_daily(w.stg_adjust, w.as_of)
    a = ua.agg(F.sum("spend")).collect()[0][0]
    b = w.stg_adjust.agg(F.sum("cost")).collect()[0][0]
    assert abs(a - b) < 1e-6 * max(1.0, abs(b))
    # overview keeps every (date, platform, country) of both sides
    eng = marts.engagement_daily(w.stg_unity, w.as_of)
    ov = marts.overview_daily(ua, eng).select("date", "platform", "country").distinct()
    for side in (ua, eng):
        keys = side.select("date", "platform", "country").distinct()
        assert keys.join(ov, ["date", "platform", "country"], "left_anti").count() == 0
