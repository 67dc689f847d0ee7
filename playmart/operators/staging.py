"""Staging layer: raw feeds -> typed, renamed, flat tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.columns import TRACKED_EVENT_NAMES, action_value, hash_pii, map_param, params_map
from playmart.functions.scans import level_runs
from playmart.session import AS_OF

# event_params keys pivoted into columns, as (output column, key, value type),
# in the reference's column order.
INT_PARAMS = (
    ("booster_id", "booster_id"), ("day_num", "day_num"), ("double_reward", "doubleReward"),
    ("engagement_time_msec", "engagement_time_msec"), ("entrances", "entrances"),
    ("firebase_conversion", "firebase_conversion"), ("food_id", "food_id"),
    ("ga_session_id", "ga_session_id"), ("ga_session_number", "ga_session_number"),
    ("gem_cost", "gem_cost"), ("level_id", "level_id"), ("level_num", "level_num"),
    ("new_avatar_id", "newAvatarId"), ("object_id", "object_id"), ("object_level", "object_level"),
    ("price", "price"), ("price_gems", "price_gems"), ("quantity", "quantity"),
    ("quest_id", "quest_id"), ("refresh", "refresh"), ("reward_amount", "reward_amount"),
    ("staff_id", "staff_id"), ("staff_level", "staff_level"), ("step_num", "step_num"),
    ("time", "time"), ("param_timestamp", "timestamp"), ("tutorial_id", "tutorial_id"),
    ("validated", "validated"),
)
DOUBLE_PARAMS = (("price_dollars", "price_dollars"), ("time_spent", "time_spent"))
STRING_PARAMS = (
    ("currency", "currency"), ("currency_type", "currency_type"), ("param_event_name", "event_name"),
    ("firebase_event_origin", "firebase_event_origin"), ("from_screen", "from_screen"),
    ("item_name", "item_name"), ("location", "location"), ("new_name", "newName"),
    ("object_name", "object_name"), ("placement", "placement"), ("product_id", "product_id"),
    ("product_name", "product_name"), ("reason", "reason"), ("reward_type", "reward_type"),
    ("param_source", "source"), ("status", "status"), ("to_screen", "to_screen"), ("type", "type"),
    ("with_ads", "with_ads"),
)

# Output column order of the flattened event tables (85 columns).
EVENT_COLUMNS = (
    "event_date", "event_timestamp", "event_name", "event_value_in_usd", "user_pseudo_id",
    "user_first_touch_timestamp",
    "device_category", "device_mobile_brand_name", "device_mobile_model_name",
    "device_mobile_marketing_name", "device_mobile_os_hardware_model", "device_operating_system",
    "device_operating_system_version", "device_language", "device_is_limited_ad_tracking",
    "device_time_zone_offset_seconds",
    "geo_continent", "geo_country", "geo_region", "geo_city", "geo_sub_continent", "geo_metro",
    "app_info_id", "app_version", "app_info_install_store", "app_info_firebase_app_id",
    "app_info_install_source", "traffic_source_name", "traffic_source_medium", "traffic_source_source",
    "stream_id", "platform",
    *[c for c, _ in INT_PARAMS], "param_value", "amount", "price_dollars", "time_spent", "ad",
    *[c for c, _ in STRING_PARAMS], "user_id",
)


def _suffix(d: _dt.date) -> str:
    return d.strftime("%Y%m%d")


def ga4_shard_scan(raw: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """Finalized shards up to yesterday (full) or for the 2-day look-back (incremental).

    The comparison is on the string suffix, so ``intraday_...`` suffixes sort above every date
    and are never picked up. On a table partitioned by suffix this prunes partitions.
    """
    hi = _suffix(as_of - _dt.timedelta(days=1))
    sfx = F.col("table_suffix")
    if incremental:
        return raw.where(sfx.between(_suffix(as_of - _dt.timedelta(days=2)), hi))
    return raw.where(sfx <= hi)


def tracked_event_filter(df: DataFrame) -> DataFrame:
    """Keep the 44 allow-listed event names (pushed into the Parquet scan as an In filter)."""
    return df.where(F.col("event_name").isin(*TRACKED_EVENT_NAMES))


def flatten_events(raw: DataFrame) -> DataFrame:
    """Flatten structs, pivot event_params into typed columns, hash user_id (85 columns).

    Column pruning drops every param expression a downstream model does not read. The params
    array becomes one map per row (``_pm``) and every pivoted column is a map lookup.
    """
    raw = raw.withColumn("_pm", params_map("event_params"))
    pm = F.col("_pm")

    def param(_, key, value_type):
        return map_param(pm, key, value_type)

    p = "event_params"
    cols = [
        F.to_date(F.col("event_date"), "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("event_name"),
        F.col("event_value_in_usd"),
        F.col("user_pseudo_id"),
        F.timestamp_micros("user_first_touch_timestamp").cast("timestamp_ntz").alias("user_first_touch_timestamp"),
    ]
    for f in ("category", "mobile_brand_name", "mobile_model_name", "mobile_marketing_name",
              "mobile_os_hardware_model", "operating_system", "operating_system_version", "language",
              "is_limited_ad_tracking", "time_zone_offset_seconds"):
        cols.append(F.col(f"device.{f}").alias(f"device_{f}"))
    for f in ("continent", "country", "region", "city", "sub_continent", "metro"):
        cols.append(F.col(f"geo.{f}").alias(f"geo_{f}"))
    cols += [
        F.col("app_info.id").alias("app_info_id"),
        F.col("app_info.version").alias("app_version"),
        F.col("app_info.install_store").alias("app_info_install_store"),
        F.col("app_info.firebase_app_id").alias("app_info_firebase_app_id"),
        F.col("app_info.install_source").alias("app_info_install_source"),
        F.col("traffic_source.name").alias("traffic_source_name"),
        F.col("traffic_source.medium").alias("traffic_source_medium"),
        F.col("traffic_source.source").alias("traffic_source_source"),
        F.col("stream_id"), F.col("platform"),
    ]
    cols += [param(p, key, "int").alias(out) for out, key in INT_PARAMS]
    cols += [
        F.coalesce(param(p, "value", "int").cast("double"), param(p, "value", "double")).alias("param_value"),
        F.coalesce(param(p, "amount", "double"), param(p, "amount", "int").cast("double")).alias("amount"),
    ]
    cols += [param(p, key, "double").alias(out) for out, key in DOUBLE_PARAMS]
    cols.append(param(p, "ad", "int").alias("ad"))
    cols += [param(p, key, "string").alias(out) for out, key in STRING_PARAMS]
    cols.append(hash_pii(F.col("user_id")).alias("user_id"))
    return raw.select(*cols)


def stg_events_daily(raw: DataFrame, as_of: _dt.date = AS_OF, incremental: bool = False) -> DataFrame:
    """Finalized events, flattened."""
    return flatten_events(tracked_event_filter(ga4_shard_scan(raw, as_of, incremental)))


def stg_events_intraday(raw: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """today's intraday snapshot, same projection."""
    day = _suffix(as_of)
    snap = raw.where((F.col("table_suffix") == f"intraday_{day}") & (F.col("event_date") == day))
    return flatten_events(tracked_event_filter(snap))


def stg_events_union(daily: DataFrame, intraday: DataFrame, finalized: DataFrame | None = None) -> DataFrame:
    """Daily UNION ALL intraday by column name.

    ``intraday`` holds one date (S8). Its rows count only while that date has no finalized rows.
    ``finalized`` gives the finalized dates to check against: callers that know the snapshot's date pass the
    daily rows of that shard or partition only (``finalized_on``), so the export is not scanned a second time.
    """
    cols = list(EVENT_COLUMNS)
    if finalized is None:
        days = intraday.select("event_date").distinct()  # one row per snapshot day
        finalized = daily.select("event_date").join(F.broadcast(days), "event_date", "left_semi")
    fresh = intraday.join(F.broadcast(finalized.select("event_date").distinct()), "event_date", "left_anti")
    return daily.select(*cols).unionByName(fresh.select(*cols))


def finalized_on(raw: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """The date of the snapshot if its finalized shard is among the daily ones: a static filter on the shard suffix,
    which leaves no partition to read as long as the shard is newer than the daily ones."""
    shard = tracked_event_filter(ga4_shard_scan(raw, as_of).where(F.col("table_suffix") == _suffix(as_of)))
    return shard.select(F.to_date(F.col("event_date"), "yyyyMMdd").alias("event_date"))


def level_neighbors(runs: DataFrame, user: str = "user_pseudo_id") -> DataFrame:
    """One row per (user, run) with the run's level and the previous/next run's level.

    All rows of a run carry the same three values (``event_level_runs``), so this is one
    pre-aggregated grouping."""
    return runs.groupBy(user, "level_run_id").agg(
        *(F.max(c).alias(c) for c in ("level_id", "previous_level_id", "next_level_id")))


def event_level_runs(unioned: DataFrame) -> DataFrame:
    """S10+S11: drop NULL users, forward-fill level_id and number level runs (segmented scan).

    Rows with a NULL user are dropped first (the reference's USING join drops them at the end;
    filtering first avoids one giant NULL-key partition)."""
    return level_runs(unioned.where(F.col("user_pseudo_id").isNotNull()))


def stg_events(unioned: DataFrame) -> DataFrame:
    """Unioned events with filled level_id and previous/next distinct level (87 columns).

    The wide rows are exchanged once, on (user, hour segment); what crosses segments is joined from
    one narrow row per segment on the partitioning the rows already have (``scans.level_runs``)."""
    return event_level_runs(unioned).select(*EVENT_COLUMNS, "previous_level_id", "next_level_id")


def stg_adjust__report(raw: DataFrame) -> DataFrame:
    """Adjust report renamed, country upper-cased, platform lower-cased, is_paid flag."""
    c = F.col
    dims = [
        c("day").alias("date"), c("app"), c("app_token"), c("store_id"), c("store_type"), c("network"),
        c("campaign"), c("campaign_id_network").alias("campaign_id"), c("adgroup"),
        c("adgroup_id_network").alias("adgroup_id"), c("source_network").alias("source"),
        c("source_id_network").alias("source_id"), c("creative"), c("creative_id_network").alias("creative_id"),
        F.upper(F.coalesce(c("country_code"), F.lit(""))).alias("country"), c("region"),
        F.lower(F.coalesce(c("os_name"), F.lit(""))).alias("platform"), c("device_type"), c("channel"),
        c("partner_name"), c("partner_id"),
    ]
    measures = (
        "installs", "network_installs", "organic_installs", "non_organic_installs", "reinstalls",
        "first_reinstalls", "reattributions", "reattribution_reinstalls", "uninstalls",
        "first_uninstalls", "uninstall_cohort", "sessions", "base_sessions", "daus", "waus", "maus",
        "clicks", "attribution_clicks", "network_clicks", "impressions", "attribution_impressions",
        "network_impressions", "events", "revenue_events", "paid_clicks", "paid_impressions",
        "paid_installs", "ad_impressions", "cost", "adjust_cost", "network_cost", "ecpi", "ecpi_all",
        "network_ecpi", "ecpc", "ecpm", "network_ecpm", "click_cost", "impression_cost",
        "install_cost", "revenue", "cohort_revenue", "all_revenue", "ad_revenue", "ad_rpm", "arpdau",
        "arpdau_ad", "arpdau_iap", "gross_profit", "return_on_investment", "revenue_to_cost", "roas",
        "roas_ad", "roas_iap", "click_conversion_rate", "ctr", "impression_conversion_rate",
    )
    return raw.select(*dims, *measures, (F.coalesce(c("cost"), F.lit(0.0)) > 0).alias("is_paid"))


_META_COMMON = (
    "attribution_setting", "impressions", "reach", "frequency", "full_view_impressions",
    "full_view_reach", "clicks", "inline_link_clicks", "unique_clicks", "unique_inline_link_clicks",
    "inline_post_engagement", "spend", "social_spend", "cpm", "cpc", "cpp", "ctr", "unique_ctr",
    "inline_link_click_ctr", "unique_inline_link_click_ctr",
)
PURCHASE = "app_custom_event.fb_mobile_purchase"


def _meta_actions():
    return [
        action_value("actions", "mobile_app_install").alias("installs"),
        action_value("actions", PURCHASE).alias("purchases"),
        action_value("action_values", PURCHASE).alias("purchase_value"),
        action_value("actions", "link_click").alias("link_clicks"),
        action_value("mobile_app_purchase_roas", PURCHASE).alias("mobile_app_purchase_roas"),
    ]


def stg_meta_ads__campaign_daily(raw: DataFrame) -> DataFrame:
    """Campaign-grain Meta report with ids as strings and extracted actions."""
    c = F.col
    return raw.select(
        c("date_start").alias("date"), c("account_id").cast("string").alias("account_id"),
        c("account_name"), c("account_currency"), c("campaign_id").cast("string").alias("campaign_id"),
        c("campaign_name"), c("objective"), c("buying_type"), *_META_COMMON, *_meta_actions(),
        c("actions"), c("action_values"), c("unique_actions"), c("cost_per_action_type"), c("purchase_roas"),
    )


def stg_meta_ads__ad_daily(raw: DataFrame) -> DataFrame:
    """Ad-grain Meta report: as S16 plus adset/ad ids and seven video metrics."""
    c = F.col
    video = [
        action_value("video_play_actions", "video_view").alias("video_plays"),
        action_value("video_thruplay_watched_actions", "video_view").alias("video_thruplays"),
        action_value("video_p25_watched_actions", "video_view").alias("video_p25"),
        action_value("video_p50_watched_actions", "video_view").alias("video_p50"),
        action_value("video_p75_watched_actions", "video_view").alias("video_p75"),
        action_value("video_p100_watched_actions", "video_view").alias("video_p100"),
        action_value("video_avg_time_watched_actions", "video_view").alias("video_avg_time_watched"),
    ]
    return raw.select(
        c("date_start").alias("date"), c("account_id").cast("string").alias("account_id"),
        c("account_name"), c("account_currency"), c("campaign_id").cast("string").alias("campaign_id"),
        c("campaign_name"), c("adset_id").cast("string").alias("adset_id"), c("adset_name"),
        c("ad_id").cast("string").alias("ad_id"), c("ad_name"), *_META_COMMON, *_meta_actions(), *video,
        c("actions"), c("action_values"), c("unique_actions"), c("cost_per_action_type"), c("purchase_roas"),
    )


def stg_unity__analytics_daily(raw: DataFrame) -> DataFrame:
    """Unity report, camelCase -> snake_case, platform 'mac_client' -> 'mac'."""
    c = F.col
    plat = F.lower(F.coalesce(c("platform"), F.lit("")))
    return raw.select(
        c("day").alias("date"),
        F.upper(F.coalesce(c("country"), F.lit(""))).alias("country"),
        F.when(plat == "mac_client", F.lit("mac")).otherwise(plat).alias("platform"),
        c("clientVersion").alias("client_version"), c("acquisitionChannel").alias("acquisition_channel"),
        c("uniqueUsers").alias("dau"), c("newUsers").alias("new_users"), c("WAU").alias("wau"),
        c("MAU").alias("mau"), c("newVsReturning").alias("new_vs_returning"),
        c("totalRevenue").alias("total_revenue"), c("iapRevenue").alias("iap_revenue"),
        c("ARPDAU").alias("arpdau"), c("ARPPU").alias("arppu"), c("payers"),
        c("revenuePerTransaction").alias("revenue_per_transaction"),
        c("totalTransactions").alias("total_transactions"),
        c("d1Retention").alias("d1_retention"), c("d7Retention").alias("d7_retention"),
        c("d30Retention").alias("d30_retention"), c("numberOfSessions").alias("sessions"),
        c("sessionsPerUser").alias("sessions_per_user"), c("averageSessionLength").alias("avg_session_length"),
        c("playTimePerUser").alias("play_time_per_user"),
    )


def all_dates(spark: SparkSession, start: _dt.date = _dt.date(2025, 10, 1),
              end: _dt.date = _dt.date(2027, 1, 1)) -> DataFrame:
    """Date spine, one row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))
