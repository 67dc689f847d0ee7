"""Marts (P1-P11): grouped daily facts. Every function takes its staged inputs plus ``as_of`` and
``incremental`` (look-back predicate on the partition date) and returns a lazy DataFrame."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.functions.columns import (IAP_EVENT_NAMES, NOISE_EVENTS, iap_value_usd,
                                        is_iap_revenue_event, not_test_country, safe_divide)
from playmart.operators.players import spender_segment
from playmart.session import AS_OF
from playmart.sources.sinks import incremental_window

MART_LOOKBACK_DAYS = 14
MAX_DSI = 30

PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.99)
PCT_NAMES = ("p25", "p50", "p75", "p90", "p99")


def ua_performance_daily(stg_adjust: DataFrame, as_of: _dt.date = AS_OF,
                         incremental: bool = False) -> DataFrame:
    """Adjust report at (date, app, platform, country, network=channel, campaign, campaign_id)."""
    src = incremental_window(stg_adjust, "date", as_of, MART_LOOKBACK_DAYS, incremental)
    s = lambda c: F.sum(c)
    g = src.groupBy("date", "app", "platform", "country", F.col("channel").alias("network"),
                    "campaign", "campaign_id").agg(
        *[s(c).alias(c) for c in ("impressions", "clicks", "installs", "paid_installs",
                                   "organic_installs", "reattributions", "reinstalls", "uninstalls",
                                   "daus", "sessions", "events", "revenue_events")],
        s("cost").alias("spend"),
        *[s(c).alias(c) for c in ("revenue", "cohort_revenue", "ad_revenue", "all_revenue", "gross_profit")],
    )
    c = F.col
    return g.select(
        "*",
        safe_divide(c("clicks"), c("impressions")).alias("ctr"),
        safe_divide(c("installs"), c("clicks")).alias("cvr"),
        (safe_divide(c("spend"), c("impressions")) * 1000).alias("ecpm"),
        safe_divide(c("spend"), c("clicks")).alias("ecpc"),
        safe_divide(c("spend"), c("installs")).alias("ecpi"),
        safe_divide(c("revenue"), c("daus")).alias("arpdau"),
        safe_divide(c("ad_revenue"), c("daus")).alias("arpdau_ad"),
        safe_divide(c("all_revenue"), c("daus")).alias("arpdau_all"),
        safe_divide(c("revenue"), c("all_revenue")).alias("iap_share"),
        safe_divide(c("ad_revenue"), c("all_revenue")).alias("ad_share"),
        safe_divide(c("cohort_revenue"), c("spend")).alias("roas"),
        safe_divide(c("ad_revenue"), c("spend")).alias("roas_ad"),
        safe_divide(c("all_revenue") - c("spend"), c("spend")).alias("roi"),
    )


def engagement_daily(stg_unity: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """Unity report at (date, country, platform); rates DAU-weighted."""
    src = incremental_window(stg_unity, "date", as_of, MART_LOOKBACK_DAYS, incremental)
    c = F.col
    wsum = lambda col: F.sum(c(col) * c("dau"))
    g = src.groupBy("date", "country", "platform").agg(
        F.sum("dau").alias("dau"), F.sum("new_users").alias("new_users"),
        F.max("wau").alias("wau"), F.max("mau").alias("mau"), F.sum("payers").alias("payers"),
        F.sum("total_revenue").alias("total_revenue"), F.sum("iap_revenue").alias("iap_revenue"),
        F.sum("total_transactions").alias("total_transactions"), F.sum("sessions").alias("sessions"),
        *[wsum(m).alias(f"_w_{m}") for m in ("d1_retention", "d7_retention", "d30_retention",
                                              "sessions_per_user", "avg_session_length", "play_time_per_user")],
    )
    return g.select(
        "date", "country", "platform", "dau", "new_users", "wau", "mau", "payers", "total_revenue",
        "iap_revenue", "total_transactions", "sessions",
        safe_divide(c("total_revenue"), c("dau")).alias("arpdau"),
        safe_divide(c("iap_revenue"), c("payers")).alias("arppu"),
        safe_divide(c("iap_revenue"), c("total_transactions")).alias("revenue_per_transaction"),
        *[safe_divide(c(f"_w_{m}"), c("dau")).alias(m)
          for m in ("d1_retention", "d7_retention", "d30_retention", "sessions_per_user",
                    "avg_session_length", "play_time_per_user")],
    )


def spender_lookup(events: DataFrame) -> DataFrame:
    """One row per user: 'spender' if the user ever had a monetised IAP event (full history)."""
    return events.where(F.col("user_pseudo_id").isNotNull()).groupBy("user_pseudo_id").agg(
        F.when(F.max(F.when(is_iap_revenue_event(), 1).otherwise(0)) == 1, F.lit("spender"))
         .otherwise(F.lit("non_spender")).alias("spender_segment"))


def iap_arpdau_daily(events: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False,
                     players: DataFrame | None = None) -> DataFrame:
    """(date, geo, app_version, spender_segment) -> dau, iap revenue/transactions, arpdau.

    The spender lookup is one row per user; the join is on the user key and AQE chooses the
    strategy from the measured size (broadcast only below its threshold). With ``players`` (the maintained
    dimension of ``plans.players``) the lookup is that table, so an incremental run reads its look-back only.
    """
    seg = spender_lookup(events) if players is None else players.select("user_pseudo_id", spender_segment().alias("spender_segment"))
    e = events.where(F.col("user_pseudo_id").isNotNull() & not_test_country())
    e = incremental_window(e, "event_date", as_of, MART_LOOKBACK_DAYS, incremental)
    rev = F.when(F.col("event_name").isin(*IAP_EVENT_NAMES), iap_value_usd()).otherwise(F.lit(0.0))
    # one row per user and day before the segment is joined: events are combined in the map tasks
    e = e.groupBy(F.col("event_date").alias("date"), F.coalesce("geo_country", F.lit("unknown")).alias("geo_country"),
                  F.coalesce("app_version", F.lit("unknown")).alias("app_version"), "user_pseudo_id").agg(
        F.sum(rev).alias("revenue"), F.count_if(is_iap_revenue_event()).alias("transactions"))
    e = e.join(seg, "user_pseudo_id", "left")
    g = e.groupBy("date", "geo_country", "app_version",
                  F.coalesce("spender_segment", F.lit("non_spender")).alias("spender_segment")).agg(
        F.count("*").alias("dau"), F.sum("revenue").alias("iap_revenue"),
        F.sum("transactions").alias("iap_transactions"))
    return g.withColumn("arpdau_iap", safe_divide(F.col("iap_revenue"), F.col("dau")))


def cohort_assignments(events: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """First ``first_open`` per user (outside the test country): cohort date, geo and version.

    The least (moment, day, country, version) of the user's first_open rows is an aggregate, so it
    combines map-side, a hot user never needs one ordered partition and tied moments give one answer."""
    fo = events.where((F.col("event_name") == "first_open") & F.col("user_pseudo_id").isNotNull()
                      & not_test_country())
    fo = incremental_window(fo, "event_date", as_of, MAX_DSI + MART_LOOKBACK_DAYS, incremental)
    first = F.min(F.struct(
        "event_timestamp", F.col("event_date").alias("cohort_date"),
        F.coalesce("geo_country", F.lit("unknown")).alias("geo_country"),
        F.coalesce("app_version", F.lit("unknown")).alias("app_version")))
    return fo.groupBy("user_pseudo_id").agg(first.alias("c")).select(
        "user_pseudo_id", "c.cohort_date", "c.geo_country", "c.app_version")


def cohort_ltv_daily(events: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """(cohort_date, days_since_install 0..30, geo, version) -> cohort size and IAP revenue,
    zero-filled, only for days that have fully elapsed before ``as_of``."""
    cohorts = cohort_assignments(events, as_of, incremental)
    keys = ["cohort_date", "geo_country", "app_version"]
    sizes = cohorts.groupBy(*keys).agg(F.countDistinct("user_pseudo_id").alias("cohort_size"))
    iap = events.where(is_iap_revenue_event())
    iap = incremental_window(iap, "event_date", as_of, MAX_DSI + MART_LOOKBACK_DAYS, incremental)
    dsi = F.datediff(F.col("event_date"), F.col("cohort_date"))
    per = (cohorts.join(iap.select("user_pseudo_id", "event_date", "event_value_in_usd", "price_dollars"),
                        "user_pseudo_id")
           .where(dsi.between(0, MAX_DSI))
           .groupBy(*keys, dsi.cast("bigint").alias("days_since_install"))
           .agg(F.sum(iap_value_usd()).alias("iap_revenue"),
                F.count(F.lit(1)).alias("iap_transactions"),
                F.countDistinct("user_pseudo_id").alias("paying_users")))
    # The grid is cohorts x 31 rows, built after the small aggregate, never before.
    grid = sizes.select(*keys, "cohort_size", F.explode(F.sequence(F.lit(0), F.lit(MAX_DSI))).alias("_dsi"))
    grid = grid.withColumn("days_since_install", F.col("_dsi").cast("bigint")).drop("_dsi")
    grid = grid.where(F.date_add(F.col("cohort_date"), F.col("days_since_install").cast("int")) < F.lit(as_of))
    out = grid.join(per, [*keys, "days_since_install"], "left")
    return out.select(
        "cohort_date", "days_since_install", "geo_country", "app_version", "cohort_size",
        F.coalesce("iap_revenue", F.lit(0.0)).alias("iap_revenue"),
        F.coalesce("iap_transactions", F.lit(0).cast("bigint")).alias("iap_transactions"),
        F.coalesce("paying_users", F.lit(0).cast("bigint")).alias("paying_users"))


CREATIVE_COLUMNS = (
    "date", "account_id", "account_name", "campaign_id", "campaign_name", "adset_id", "adset_name",
    "ad_id", "ad_name", "impressions", "reach", "frequency", "clicks", "inline_link_clicks",
    "unique_clicks", "inline_post_engagement", "spend", "cpm", "cpc", "ctr", "unique_ctr",
    "installs", "purchases", "purchase_value", "link_clicks", "mobile_app_purchase_roas",
    "video_plays", "video_thruplays", "video_p25", "video_p50", "video_p75", "video_p100",
    "video_avg_time_watched",
)


def creative_performance_daily(stg_meta_ad: DataFrame, as_of: _dt.date = AS_OF,
                               incremental: bool = False) -> DataFrame:
    """P5: Meta ad grain, no aggregation: pass-through plus three rates."""
    src = incremental_window(stg_meta_ad, "date", as_of, MART_LOOKBACK_DAYS, incremental)
    c = F.col
    return src.select(
        *CREATIVE_COLUMNS,
        safe_divide(c("spend"), c("installs")).alias("ecpi_meta"),
        safe_divide(c("installs"), c("clicks")).alias("cvr_meta"),
        safe_divide(c("video_p100"), c("video_plays")).alias("video_completion_rate"),
    )


def ua_funnel_daily(stg_adjust: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """Funnel at (date, app, platform, country, network, campaign); here ``network`` is the
    raw Adjust network, not the channel (as in the reference)."""
    src = incremental_window(stg_adjust, "date", as_of, MART_LOOKBACK_DAYS, incremental)
    g = src.groupBy("date", "app", "platform", "country", "network", "campaign").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("installs").alias("installs"), F.sum("events").alias("events"),
        F.sum("revenue_events").alias("revenue_events"), F.sum("cost").alias("spend"),
        F.sum("revenue").alias("revenue"), F.sum("cohort_revenue").alias("cohort_revenue"))
    c = F.col
    return g.select(
        "*",
        safe_divide(c("clicks"), c("impressions")).alias("impr_to_click_rate"),
        safe_divide(c("installs"), c("clicks")).alias("click_to_install_rate"),
        safe_divide(c("events"), c("installs")).alias("install_to_event_rate"),
        safe_divide(c("revenue_events"), c("installs")).alias("install_to_purchase_rate"),
        safe_divide(c("spend"), c("installs")).alias("cpi"),
        safe_divide(c("cohort_revenue"), c("installs")).alias("install_arpu_d0"),
    )


def _session_events(events: DataFrame, as_of: _dt.date, incremental: bool) -> DataFrame:
    e = events.where(F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull()
                     & not_test_country())
    e = incremental_window(e, "event_date", as_of, MART_LOOKBACK_DAYS, incremental)
    return e.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id", "level_id",
        F.coalesce("platform", F.lit("unknown")).alias("platform"),
        F.coalesce("app_version", F.lit("unknown")).alias("app_version"),
        F.coalesce("geo_country", F.lit("unknown")).alias("geo_country"))


def sessions(events: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """One row per (user, ga_session_id). Session dims use ``min`` (the reference's
    ANY_VALUE is nondeterministic)."""
    e = _session_events(events, as_of, incremental)
    ts = F.col("event_timestamp")
    return e.groupBy("user_pseudo_id", "ga_session_id").agg(
        F.min("event_date").alias("session_date"),
        F.min("platform").alias("platform"), F.min("app_version").alias("app_version"),
        F.min("geo_country").alias("geo_country"),
        F.count_if(~F.col("event_name").isin(*NOISE_EVENTS)).alias("events_in_session"),
        F.timestamp_diff("SECOND", F.min(ts), F.max(ts)).alias("duration_seconds"),
        F.countDistinct(F.when(F.col("event_name") == "level_started", F.col("level_id"))).alias("levels_in_session"),
    )


def session_user_days(sess: DataFrame) -> DataFrame:
    """(date, platform, version, geo, user) -> distinct sessions that day."""
    return sess.groupBy(F.col("session_date").alias("date"), "platform", "app_version", "geo_country",
                        "user_pseudo_id").agg(F.countDistinct("ga_session_id").alias("sessions_in_day"))


SESSION_METRICS = {"events_per_session": "events_in_session", "duration_seconds": "duration_seconds",
                   "levels_per_session": "levels_in_session"}


def counted_percentiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, mean and discrete percentiles p25..p99 of each (``keys``, metric) from mergeable counts (``keys``, metric, value, n).

    A running sum over the distinct values in order finds the least value that ``p`` percent of the rows do
    not exceed; sums and comparisons are whole numbers. Counts of several days or tables may be added up first."""
    w = Window.partitionBy(*keys, "metric")
    upto = w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    given = F.when(F.col("value").isNotNull(), F.col("n"))  # nulls come first and count for nothing
    c = counts.withColumn("_cum", F.sum(given).over(upto)).withColumn("_all", F.sum(given).over(w))
    pick = [F.min(F.when(F.col("_cum") * 100 >= F.col("_all") * round(100 * p), F.col("value"))).cast("double").alias(n)
            for p, n in zip(PERCENTILES, PCT_NAMES)]
    mean = F.sum(F.col("value") * F.col("n")) / F.sum(given)
    return c.groupBy(*keys, "metric").agg(F.sum("n").alias("rows"), mean.alias("avg"), *pick)


def session_values(sess: DataFrame, keys: list[str]) -> DataFrame:
    """(``keys``, metric, value): one row per session and metric, and one per user-day for sessions_per_user."""
    pairs = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(c).cast("long").alias("value")) for m, c in SESSION_METRICS.items()))
    per_session = sess.select(F.col("session_date").alias("date"), *keys[1:], F.explode(pairs).alias("x"))
    per_day = session_user_days(sess)
    return per_session.select(*keys, "x.metric", "x.value").unionByName(per_day.select(
        *keys, F.lit("sessions_per_user").alias("metric"), F.col("sessions_in_day").cast("long").alias("value")))


def session_depth_daily(events: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False,
                        exact: bool = False, accuracy: int = 10000, sess: DataFrame | None = None) -> DataFrame:
    """(date, platform, version, geo) -> sessions, user-days, avg + p25..p99 of events per
    session, duration, levels per session and sessions per user-day.

    Exact mode works on counts per distinct value, which combine in the map tasks, so no group's values
    are held in one buffer; approximate mode evaluates one ``percentile_approx`` with an array of fractions (one
    sketch per group and metric). ``sess``: the stored sessions (P7), if there are any."""
    keys = ["date", "platform", "app_version", "geo_country"]
    sess = sessions(events, as_of, incremental) if sess is None else sess
    values = session_values(sess, keys)
    if exact:
        counts = values.groupBy(*keys, "metric", "value").agg(F.count("*").alias("n"))
        dist = counted_percentiles(counts, keys)
    else:
        q = F.percentile_approx("value", list(PERCENTILES), accuracy)
        dist = values.groupBy(*keys, "metric").agg(q.alias("q"), F.count("*").alias("rows"), F.avg("value").alias("avg")).select(
            *keys, "metric", "rows", "avg", *(F.col("q")[i].cast("double").alias(n) for i, n in enumerate(PCT_NAMES)))
    of = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    metrics = (*SESSION_METRICS, "sessions_per_user")
    return dist.groupBy(*keys).agg(
        of("events_per_session", "rows").alias("sessions"), of("sessions_per_user", "rows").alias("user_days"),
        *(of(m, c).alias(f"{c}_{m}") for m in metrics for c in ("avg", *PCT_NAMES)))


def tutorial_funnel_daily(events: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """P10: (date, version, geo, platform, tutorial_id, step_num) -> users, events.
    ``step_num`` is NULL on completion rows (NULL is its own group)."""
    e = events.where(F.col("event_name").isin("tutorial_step", "tutorial_completed")
                     & F.col("user_pseudo_id").isNotNull() & F.col("tutorial_id").isNotNull()
                     & not_test_country())
    e = incremental_window(e, "event_date", as_of, MART_LOOKBACK_DAYS, incremental)
    return e.groupBy(
        F.col("event_date").alias("date"),
        F.coalesce("app_version", F.lit("unknown")).alias("app_version"),
        F.coalesce("geo_country", F.lit("unknown")).alias("geo_country"),
        F.coalesce("platform", F.lit("unknown")).alias("platform"),
        "tutorial_id",
        F.when(F.col("event_name") == "tutorial_step", F.col("step_num")).alias("step_num"),
    ).agg(F.countDistinct("user_pseudo_id").alias("users"), F.count(F.lit(1)).alias("events"))


def overview_daily(ua: DataFrame, eng: DataFrame) -> DataFrame:
    """UA (per app) FULL OUTER JOIN engagement (no app) on (date, platform, country).

    Both sides are aggregated before the join. Engagement rows repeat once per app of the same
    cell (the reference's fan-out); engagement-only cells get a NULL app."""
    c = F.col
    u = ua.groupBy("date", "app", "platform", "country").agg(
        *[F.sum(x).alias(x) for x in ("installs", "paid_installs", "organic_installs", "spend", "revenue",
                                       "cohort_revenue", "ad_revenue", "impressions", "clicks")])
    u = u.withColumn("ecpi", safe_divide(c("spend"), c("installs"))).withColumn(
        "roas", safe_divide(c("cohort_revenue"), c("spend")))
    g = eng.groupBy("date", "platform", "country").agg(
        F.sum("dau").alias("dau"), F.sum("new_users").alias("new_users"), F.sum("payers").alias("payers"),
        F.sum("total_revenue").alias("engagement_total_revenue"),
        F.sum("iap_revenue").alias("engagement_iap_revenue"), F.sum("sessions").alias("sessions"),
        *[F.sum(c(m) * c("dau")).alias(f"_w_{m}") for m in ("d1_retention", "d7_retention", "d30_retention")])
    g = g.select(
        "date", "platform", "country", "dau", "new_users", "payers", "engagement_total_revenue",
        "engagement_iap_revenue", "sessions",
        safe_divide(c("engagement_total_revenue"), c("dau")).alias("arpdau"),
        safe_divide(c("engagement_iap_revenue"), c("payers")).alias("arppu"),
        *[safe_divide(c(f"_w_{m}"), c("dau")).alias(m) for m in ("d1_retention", "d7_retention", "d30_retention")])
    u, g = u.alias("ua"), g.alias("eng")
    cond = ((c("ua.date") == c("eng.date")) & (c("ua.platform") == c("eng.platform"))
            & (c("ua.country") == c("eng.country")))
    j = u.join(g, cond, "full_outer")
    return j.select(
        F.coalesce(c("ua.date"), c("eng.date")).alias("date"), c("ua.app").alias("app"),
        F.coalesce(c("ua.platform"), c("eng.platform")).alias("platform"),
        F.coalesce(c("ua.country"), c("eng.country")).alias("country"),
        *[c(f"ua.{x}").alias(x) for x in ("installs", "paid_installs", "organic_installs", "impressions",
                                          "clicks", "spend")],
        c("ua.revenue").alias("adjust_revenue"), c("ua.cohort_revenue").alias("cohort_revenue"),
        c("ua.ad_revenue").alias("adjust_ad_revenue"), c("ua.ecpi").alias("ecpi"), c("ua.roas").alias("roas"),
        *[c(f"eng.{x}").alias(x) for x in ("dau", "new_users", "payers", "sessions", "engagement_total_revenue",
                                           "engagement_iap_revenue", "arpdau", "arppu", "d1_retention",
                                           "d7_retention", "d30_retention")],
    )
