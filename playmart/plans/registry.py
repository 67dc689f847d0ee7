"""Registry of named queries: key -> function of a Warehouse returning a DataFrame.

work grows with them. ``finalize`` rounds float outputs to 6 places so two engines agree on
the last bits of a sum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.operators import staging
from playmart.plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def round6(c):
    """Round to 6 decimals with plain IEEE steps that every engine evaluates bit-identically:
    first to 1e-9 (absorbs last-bit noise from a different summation order), then half away
    from zero to 1e-6. Spark's decimal-string rounding and a binary rounding disagree on exact
    ties such as 4243.6532 / 32 = 132.6141625; this form does not."""
    x = c.cast("double")
    return F.round(F.round(x * F.lit(1e9), 0) / F.lit(1e3), 0) / F.lit(1e6)


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# ---- S: sources and staging ---------------------------------------------------------------

RAW_COLS = ("event_date", "event_timestamp", "event_name", "user_pseudo_id", "table_suffix")
STRUCT_COLS = ("event_date", "event_timestamp", "event_name", "event_value_in_usd", "user_pseudo_id",
               "user_first_touch_timestamp", "stream_id", "platform",
               *[c for c in staging.EVENT_COLUMNS if c.startswith(("device_", "geo_", "app_", "traffic_"))])
PARAM_COLS = ("event_timestamp", "user_pseudo_id", "event_name",
              *[c for c, _ in staging.INT_PARAMS], *[c for c, _ in staging.DOUBLE_PARAMS], "ad",
              *[c for c, _ in staging.STRING_PARAMS])


@query("ga4_shard_scan")
def q_ga4_shard_scan(w: Warehouse) -> DataFrame:
    return staging.ga4_shard_scan(w.raw_events, w.as_of, incremental=True).select(*RAW_COLS)


@query("tracked_event_filter")
def q_tracked_event_filter(w: Warehouse) -> DataFrame:
    return staging.tracked_event_filter(staging.ga4_shard_scan(w.raw_events, w.as_of)).select(*RAW_COLS)


@query("ga4_flatten_structs")
def q_ga4_flatten_structs(w: Warehouse) -> DataFrame:
    return w.stg_events_daily.select(*STRUCT_COLS)


@query("ga4_param_pivot")
def q_ga4_param_pivot(w: Warehouse) -> DataFrame:
    return w.stg_events_daily.select(*PARAM_COLS)


@query("ga4_param_numeric_coalesce")
def q_ga4_param_numeric_coalesce(w: Warehouse) -> DataFrame:
    return w.stg_events_daily.select("event_timestamp", "user_pseudo_id", "event_name", "param_value", "amount")


@query("hash_pii")
def q_hash_pii(w: Warehouse) -> DataFrame:
    return w.stg_events_daily.select("event_timestamp", "user_pseudo_id", "user_id")


@query("stg_events_daily")
def q_stg_events_daily(w: Warehouse) -> DataFrame:
    return w.stg_events_daily


@query("stg_events_intraday")
def q_stg_events_intraday(w: Warehouse) -> DataFrame:
    return w.stg_events_intraday


@query("stg_events_union")
def q_stg_events_union(w: Warehouse) -> DataFrame:
    return w.stg_events_union


@query("level_forward_fill")
def q_level_forward_fill(w: Warehouse) -> DataFrame:
    runs = staging.event_level_runs(w.stg_events_union)
    return runs.select("user_pseudo_id", "event_timestamp", "event_name", "level_id")


@query("level_runs")
def q_level_runs(w: Warehouse) -> DataFrame:
    runs = staging.event_level_runs(w.stg_events_union)
    return runs.select("user_pseudo_id", "event_timestamp", "event_name", "level_id", "level_run_id")


@query("level_neighbors")
def q_level_neighbors(w: Warehouse) -> DataFrame:
    runs = staging.event_level_runs(w.stg_events_union)
    return staging.level_neighbors(runs)


@query("stg_events")
def q_stg_events(w: Warehouse) -> DataFrame:
    return w.stg_events


@query("stg_adjust__report")
def q_stg_adjust(w: Warehouse) -> DataFrame:
    return w.stg_adjust


@query("meta_get_action")
def q_meta_get_action(w: Warehouse) -> DataFrame:
    return w.stg_meta_ad.select("date", "ad_id", "installs", "purchases", "purchase_value", "link_clicks",
                                "mobile_app_purchase_roas", "video_plays", "video_p100")


@query("stg_meta_ads__campaign_daily")
def q_stg_meta_campaign(w: Warehouse) -> DataFrame:
    return w.stg_meta_campaign.select(
        "date", "account_id", "account_name", "campaign_id", "campaign_name", "impressions", "clicks",
        "spend", "installs", "purchases", "purchase_value", "link_clicks", "mobile_app_purchase_roas")


@query("stg_meta_ads__ad_daily")
def q_stg_meta_ad(w: Warehouse) -> DataFrame:
    from playmart.operators.marts import CREATIVE_COLUMNS
    return w.stg_meta_ad.select(*CREATIVE_COLUMNS)


@query("stg_unity__analytics_daily")
def q_stg_unity(w: Warehouse) -> DataFrame:
    return w.stg_unity


@query("iap_value_usd")
def q_iap_value_usd(w: Warehouse) -> DataFrame:
    from playmart.functions.columns import iap_value_usd, is_iap_event
    e = w.stg_events
    return e.where(is_iap_event()).select("user_pseudo_id", "event_timestamp", "event_name",
                                          iap_value_usd().alias("iap_value_usd"))


@query("is_iap_revenue_event")
def q_is_iap_revenue_event(w: Warehouse) -> DataFrame:
    from playmart.functions.columns import is_iap_revenue_event
    return w.stg_events.groupBy("event_name").agg(
        F.count_if(is_iap_revenue_event()).alias("revenue_events"), F.count(F.lit(1)).alias("events"))


# ---- P: marts -------------------------------------------------------------------------------

from playmart.operators import marts  # noqa: E402


@query("ua_performance_daily")
def q_ua_performance_daily(w: Warehouse) -> DataFrame:
    return marts.ua_performance_daily(w.stg_adjust, w.as_of)


@query("engagement_daily")
def q_engagement_daily(w: Warehouse) -> DataFrame:
    return marts.engagement_daily(w.stg_unity, w.as_of)


@query("iap_arpdau_daily")
def q_iap_arpdau_daily(w: Warehouse) -> DataFrame:
    return marts.iap_arpdau_daily(w.stg_events, w.as_of)


@query("cohort_ltv_daily")
def q_cohort_ltv_daily(w: Warehouse) -> DataFrame:
    return marts.cohort_ltv_daily(w.stg_events, w.as_of)


@query("creative_performance_daily")
def q_creative_performance_daily(w: Warehouse) -> DataFrame:
    return marts.creative_performance_daily(w.stg_meta_ad, w.as_of)


@query("ua_funnel_daily")
def q_ua_funnel_daily(w: Warehouse) -> DataFrame:
    return marts.ua_funnel_daily(w.stg_adjust, w.as_of)


@query("sessions")
def q_sessions(w: Warehouse) -> DataFrame:
    return marts.sessions(w.stg_events, w.as_of)


@query("session_user_days")
def q_session_user_days(w: Warehouse) -> DataFrame:
    return marts.session_user_days(w.sessions)


@query("session_depth_daily")
def q_session_depth_daily(w: Warehouse) -> DataFrame:
    """Exact percentiles (the oracle's twin); the approximate default is ``session_depth_daily_approx``."""
    return marts.session_depth_daily(w.stg_events, w.as_of, exact=True, sess=w.sessions)


@query("session_depth_daily_approx")
def q_session_depth_daily_approx(w: Warehouse) -> DataFrame:
    return marts.session_depth_daily(w.stg_events, w.as_of, exact=False, sess=w.sessions)


@query("tutorial_funnel_daily")
def q_tutorial_funnel_daily(w: Warehouse) -> DataFrame:
    return marts.tutorial_funnel_daily(w.stg_events, w.as_of)


@query("overview_daily")
def q_overview_daily(w: Warehouse) -> DataFrame:
    return marts.overview_daily(marts.ua_performance_daily(w.stg_adjust, w.as_of),
                                marts.engagement_daily(w.stg_unity, w.as_of))


# ---- A: analytics models --------------------------------------------------------------------

from playmart.operators import analytics  # noqa: E402


@query("level_attribution")
def q_level_attribution(w: Warehouse) -> DataFrame:
    return analytics.level_attribution_events(w.stg_events)


def _events_model(key: str, fn):
    QUERIES[key] = lambda w: fn(w.stg_events)


for _k, _fn in (
    ("avg_time_spent", analytics.avg_time_spent),
    ("coins_balance", analytics.coins_balance),
    ("coins_balance_level", analytics.coins_balance_level),
    ("coins_earned_failed", analytics.coins_earned_failed),
    ("coins_earned_won", analytics.coins_earned_won),
    ("coins_earned_won_count", analytics.coins_earned_won_count),
    ("coins_failed_count", analytics.coins_failed_count),
    ("completed_players", analytics.completed_players),
    ("fail_rate", analytics.fail_rate),
    ("fail_reasons", analytics.fail_reasons),
    ("fails_count", analytics.fails_count),
    ("iap_ltv", analytics.iap_ltv),
    ("iap_overview", analytics.iap_overview),
    ("level_start_per_user", analytics.level_start_per_user),
    ("max_level_active_day", analytics.max_level_active_day),
    ("retention_abandonment_rate", analytics.retention_abandonment_rate),
    ("retention_cohorts", analytics.retention_cohorts),
    ("tries_count", analytics.tries_count),
):
    _events_model(_k, _fn)


@query("player_dimension")
def q_player_dimension(w: Warehouse) -> DataFrame:
    """The per-user lookup of P3 and A19, loaded as a daily job does: up to four days ago, then up to the day."""
    import datetime as _dt
    from playmart.plans import players
    path = _sink_path(w, "players")
    for day in (w.as_of - _dt.timedelta(days=4), w.as_of):
        df = players.load(w.spark, w.stg_events, path, day, w.database, buckets=8)
    return df.select("user_pseudo_id", "touch.cohort_date", "touch.geo_country", "touch.acquisition_source", "touch.app_version",
                     "first_spend", F.col("iap_value_usd").alias("total_iap_value_usd"))


@query("boosters_usage")
def q_boosters_usage(w: Warehouse) -> DataFrame:
    return analytics.boosters_usage(w.stg_events, w.game_objects)


@query("earned_spent_analysis")
def q_earned_spent_analysis(w: Warehouse) -> DataFrame:
    return analytics.earned_spent_analysis(w.stg_events, w.game_objects)


@query("upgrades_analysis")
def q_upgrades_analysis(w: Warehouse) -> DataFrame:
    return analytics.upgrades_analysis(w.stg_events, w.level_upgrade_recommendations)


@query("upgrades_level")
def q_upgrades_level(w: Warehouse) -> DataFrame:
    return analytics.upgrades_level(w.stg_events, w.game_objects)


# ---- R: metric recipes and consumer queries ---------------------------------------------------

from playmart.operators import metrics  # noqa: E402


def _ua(w: Warehouse) -> DataFrame:
    return marts.ua_performance_daily(w.stg_adjust, w.as_of)


def _eng(w: Warehouse) -> DataFrame:
    return marts.engagement_daily(w.stg_unity, w.as_of)


@query("roas_by_network")
def q_roas_by_network(w: Warehouse) -> DataFrame:
    return metrics.roas_by_network(_ua(w), w.as_of)


@query("overview_slice")
def q_overview_slice(w: Warehouse) -> DataFrame:
    return metrics.overview_slice(marts.overview_daily(_ua(w), _eng(w)), as_of=w.as_of)


@query("roas_by_country_daily")
def q_roas_by_country_daily(w: Warehouse) -> DataFrame:
    return metrics.roas_by_country_daily(_ua(w), as_of=w.as_of)


@query("top_campaigns_by_spend")
def q_top_campaigns_by_spend(w: Warehouse) -> DataFrame:
    return metrics.top_campaigns_by_spend(_ua(w), w.as_of)


@query("retention_trend")
def q_retention_trend(w: Warehouse) -> DataFrame:
    return metrics.retention_trend(_eng(w), w.as_of)


@query("ua_funnel_campaign")
def q_ua_funnel_campaign(w: Warehouse) -> DataFrame:
    return metrics.ua_funnel_campaign(marts.ua_funnel_daily(w.stg_adjust, w.as_of), as_of=w.as_of)


@query("cohort_retention_curve")
def q_cohort_retention_curve(w: Warehouse) -> DataFrame:
    return metrics.cohort_retention_curve(analytics.retention_cohorts(w.stg_events))


@query("cohort_ltv_curve")
def q_cohort_ltv_curve(w: Warehouse) -> DataFrame:
    return metrics.cohort_ltv_curve(marts.cohort_ltv_daily(w.stg_events, w.as_of))


@query("creative_leaderboard")
def q_creative_leaderboard(w: Warehouse) -> DataFrame:
    return metrics.creative_leaderboard(marts.creative_performance_daily(w.stg_meta_ad, w.as_of), w.as_of)


@query("tutorial_completion_rate")
def q_tutorial_completion_rate(w: Warehouse) -> DataFrame:
    return metrics.tutorial_completion_rate(marts.tutorial_funnel_daily(w.stg_events, w.as_of), w.as_of)


@query("tutorial_dropoff")
def q_tutorial_dropoff(w: Warehouse) -> DataFrame:
    return metrics.tutorial_dropoff(marts.tutorial_funnel_daily(w.stg_events, w.as_of), as_of=w.as_of)


for _k, _fn in (
    ("level_fail_rate", metrics.level_fail_rate),
    ("booster_usage_by_spender", metrics.booster_usage_by_spender),
    ("coins_net_by_level", metrics.coins_net_by_level),
    ("iap_revenue_by_product", metrics.iap_revenue_by_product),
    ("progression_by_active_day", metrics.progression_by_active_day),
    ("dau_and_revenue", metrics.dau_and_revenue),
):
    _events_model(_k, _fn)


@query("ltv_to_cac")
def q_ltv_to_cac(w: Warehouse) -> DataFrame:
    return metrics.ltv_to_cac(marts.cohort_ltv_daily(w.stg_events, w.as_of), _ua(w))


ROLLUP_METRICS = ["roas", "roas_ad", "roi", "ecpi", "ctr", "cvr", "ecpc", "ecpm", "arpdau_ua", "iap_share", "ad_share"]
# query -> (mart, dimensions); each rolls up every metric of its mart
ROLLUPS = {
    "metric_rollup_creative": ("creative_performance_daily", ["account_id", "campaign_id"]),
    "metric_rollup_engagement": ("engagement_daily", ["country"]),
    "metric_rollup_iap": ("iap_arpdau_daily", ["app_version", "spender_segment"]),
    "metric_rollup_funnel": ("ua_funnel_daily", ["network", "country"]),
    "metric_rollup_retention": ("retention_cohorts", ["acquisition_source", "spender_segment"]),
    "metric_rollup_ltv": ("cohort_ltv_daily", ["geo_country", "app_version"]),
    "metric_rollup_tutorial": ("tutorial_funnel_daily", ["tutorial_id", "platform"]),
}


@query("metric_rollup")
def q_metric_rollup(w: Warehouse) -> DataFrame:
    return metrics.metric_rollup(_ua(w), ROLLUP_METRICS, ["network", "platform"])


def _rollup(mart: str, dims: list[str]):
    names = [k for k, m in metrics.METRICS.items() if m.source == mart]
    return lambda w: metrics.metric_rollup(model(w, mart), names, dims)


for _key, _spec in ROLLUPS.items():
    QUERIES[_key] = _rollup(*_spec)


# ---- D: data-quality jobs -----------------------------------------------------------------------

from playmart.operators import quality  # noqa: E402
from playmart.plans import daily  # noqa: E402


def model(w: Warehouse, name: str) -> DataFrame:
    """A staging table, mart or analytics model by name (lazy)."""
    builders = {
        "stg_events": lambda: w.stg_events,
        "ua_performance_daily": lambda: _ua(w),
        "engagement_daily": lambda: _eng(w),
        "creative_performance_daily": lambda: marts.creative_performance_daily(w.stg_meta_ad, w.as_of),
        "ua_funnel_daily": lambda: marts.ua_funnel_daily(w.stg_adjust, w.as_of),
        "iap_arpdau_daily": lambda: marts.iap_arpdau_daily(w.stg_events, w.as_of),
        "cohort_ltv_daily": lambda: marts.cohort_ltv_daily(w.stg_events, w.as_of),
        "session_depth_daily": lambda: marts.session_depth_daily(w.stg_events, w.as_of, exact=True, sess=w.sessions),
        "tutorial_funnel_daily": lambda: marts.tutorial_funnel_daily(w.stg_events, w.as_of),
        "game_objects": lambda: w.game_objects,
        "level_upgrade_recommendations": lambda: w.level_upgrade_recommendations,
    }
    if name == "stg_events":
        return builders[name]()
    if name not in builders:  # the daily build's models without a look-back
        return w.model_table(name, lambda: daily.FULL[name](w, {t: model(w, t) for t in ("ua_performance_daily", "engagement_daily")}))
    return w.model_table(name, builders[name])


def _suite(w: Warehouse, specs, make) -> list[DataFrame]:
    """One aggregate pass per table for all of its checks of one kind."""
    by_table: dict[str, list] = {}
    for spec in specs:
        by_table.setdefault(spec[0], []).append(make(*spec[1:]))
    return [quality.table_checks(model(w, t), t, checks) for t, checks in by_table.items()]


def _not_null_suite(w: Warehouse) -> list[DataFrame]:
    return _suite(w, quality.NOT_NULL_TESTS, quality.not_null_check)


def _accepted_suite(w: Warehouse) -> list[DataFrame]:
    return _suite(w, quality.ACCEPTED_VALUES_TESTS, quality.accepted_values_check)


def _grain_suite(w: Warehouse) -> list[DataFrame]:
    return [quality.dq_unique_grain(model(w, t), t, list(keys), sev) for t, keys, sev in quality.GRAIN_TESTS]


def _range_suite(w: Warehouse) -> list[DataFrame]:
    return _suite(w, quality.RANGE_TESTS, quality.accepted_range_check)


def _rules(w: Warehouse) -> dict[str, DataFrame]:
    ua, iap, ltv = model(w, "ua_performance_daily"), model(w, "iap_arpdau_daily"), model(w, "cohort_ltv_daily")
    return {
        "dq_no_future_dates": quality.dq_no_future_dates(
            {t: (model(w, t), c) for t, c in quality.DATED_MARTS}, w.as_of),
        "dq_no_negative_revenue": quality.dq_no_negative_revenue(ua, iap, ltv),
        "dq_arpdau_consistent": quality.dq_arpdau_consistent(iap),
        "dq_ltv_elapsed": quality.dq_ltv_elapsed(ltv, w.as_of),
    }


QUERIES["dq_not_null"] = lambda w: quality.dq_summary(_not_null_suite(w))
QUERIES["dq_accepted_values"] = lambda w: quality.dq_summary(_accepted_suite(w))
QUERIES["dq_unique_grain"] = lambda w: quality.dq_summary(_grain_suite(w))
QUERIES["dq_accepted_range"] = lambda w: quality.dq_summary(_range_suite(w))
QUERIES["dq_source_freshness"] = lambda w: quality.dq_source_freshness(w.raw_adjust, "adjust_report", "day", w.as_of)
QUERIES["dq_no_future_dates"] = lambda w: _rules(w)["dq_no_future_dates"]
QUERIES["dq_no_negative_revenue"] = lambda w: _rules(w)["dq_no_negative_revenue"]
QUERIES["dq_arpdau_consistent"] = lambda w: _rules(w)["dq_arpdau_consistent"]
QUERIES["dq_ltv_elapsed"] = lambda w: _rules(w)["dq_ltv_elapsed"]


@query("dq_summary")
def q_dq_summary(w: Warehouse) -> DataFrame:
    tables = {t: model(w, t) for t in quality.declared_checks()}  # column checks are observed where tables are written
    parts = quality.column_checks(tables, w.measured) + _grain_suite(w)
    parts += [quality.rows_as_summary(df, k, k.removeprefix("dq_")) for k, df in _rules(w).items()]
    return quality.dq_summary(parts)


@query("row_counts_by_day")
def q_row_counts_by_day(w: Warehouse) -> DataFrame:
    """The daily build's marts and models, the sheets and the tables they are built from, as the catalog lists
    them; what is not built yet in this warehouse is built first."""
    for t in ("stg_events", *daily.MARTS, *daily.FULL, "game_objects", "level_upgrade_recommendations"):
        model(w, t)
    return quality.row_counts_by_day(w.catalog(), w.as_of)


# ---- T: streaming -----------------------------------------------------------------------------

from playmart.streaming import events_stream  # noqa: E402


def _stream_dirs(w: Warehouse, tag: str) -> dict[str, str]:
    import uuid
    from playmart.session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:8]}"
    return {k: f"{base}/{k}" for k in ("landing", "table", "checkpoint")}


def _land_today(w: Warehouse, landing: str) -> None:
    day = w.as_of.strftime("%Y%m%d")
    snap = w.raw_events.where(F.col("table_suffix") == f"intraday_{day}")
    events_stream.land_increments(snap, landing)


@query("stream_flatten_events")
def q_stream_flatten_events(w: Warehouse) -> DataFrame:
    d = _stream_dirs(w, "stream-flatten")
    _land_today(w, d["landing"])
    events_stream.stream_flatten_events(w.spark, d["landing"], w.raw_events.schema, d["table"], d["checkpoint"])
    return events_stream.read_events_table(w.spark, d["table"])


@query("stream_snapshot_replace")
def q_stream_snapshot_replace(w: Warehouse) -> DataFrame:
    d = _stream_dirs(w, "stream-replace")
    today = w.raw_events.where(F.col("table_suffix") == f"intraday_{w.as_of:%Y%m%d}")
    run = lambda: events_stream.stream_snapshot_replace(
        w.spark, d["landing"], w.raw_events.schema, d["table"], d["checkpoint"], w.as_of)
    # the morning's snapshot is replaced by the day's, not added to it
    events_stream.land_snapshot(today.where(F.hour(F.timestamp_micros("event_timestamp")) < 12), d["landing"], "01")
    run()
    events_stream.land_snapshot(today, d["landing"], "02")
    run()
    return events_stream.read_events_table(w.spark, d["table"])


# ---- K: sinks and incremental loads (each writes under the checkpoint folder, returns the table) ---

from playmart.sources import sinks  # noqa: E402


def _sink_path(w: Warehouse, tag: str) -> str:
    import uuid
    from playmart.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:8]}"


@query("write_view")
def q_write_view(w: Warehouse) -> DataFrame:
    """K1: a view is a named lazy plan; reading it runs the model."""
    import uuid
    name = f"overview_daily_{uuid.uuid4().hex[:8]}"
    sinks.write_view(marts.overview_daily(_ua(w), _eng(w)), name)
    return w.spark.table(name)


@query("write_table")
def q_write_table(w: Warehouse) -> DataFrame:
    """K2: full rebuild of a table partitioned by date, clustered by (app, network, country)."""
    path = _sink_path(w, "ua_performance_daily")
    sinks.write_table(_ua(w), path, partition_by=("date",), cluster_by=("app", "network", "country"))
    return w.spark.read.parquet(path)


@query("insert_overwrite_partitions")
def q_insert_overwrite_partitions(w: Warehouse) -> DataFrame:
    """K3: full build of iap_arpdau_daily, then the 14-day incremental run replaces only its
    partitions (twice, to show idempotence). The table equals the full build: the spender
    segment uses full history, so refreshed partitions carry the same rows."""
    path = _sink_path(w, "iap_arpdau_daily")
    sinks.write_table(marts.iap_arpdau_daily(w.stg_events, w.as_of), path, partition_by=("date",))
    inc = marts.iap_arpdau_daily(w.stg_events, w.as_of, incremental=True)
    sinks.insert_overwrite_partitions(inc, path, ["date"])
    sinks.insert_overwrite_partitions(inc, path, ["date"])
    return w.spark.read.parquet(path)


@query("incremental_window")
def q_incremental_window(w: Warehouse) -> DataFrame:
    """K4: the UA mart over its 14-day look-back only."""
    return marts.ua_performance_daily(w.stg_adjust, w.as_of, incremental=True)


@query("full_refresh")
def q_full_refresh(w: Warehouse) -> DataFrame:
    """K5: an incremental-only table is rebuilt in full by a static overwrite."""
    path = _sink_path(w, "ua_funnel_daily")
    sinks.write_table(marts.ua_funnel_daily(w.stg_adjust, w.as_of, incremental=True), path, partition_by=("date",))
    sinks.write_table(marts.ua_funnel_daily(w.stg_adjust, w.as_of), path, partition_by=("date",))
    return w.spark.read.parquet(path)


@query("append_new_columns")
def q_append_new_columns(w: Warehouse) -> DataFrame:
    """K6: partitions older than the look-back were written before ``play_time_per_user`` existed;
    the evolving read returns NULL for them and the value for the refreshed partitions."""
    path = _sink_path(w, "engagement_daily")
    eng = _eng(w)
    cutoff = F.date_sub(F.lit(w.as_of), marts.MART_LOOKBACK_DAYS)
    sinks.write_table(eng.where(F.col("date") < cutoff).drop("play_time_per_user"), path, partition_by=("date",))
    eng_inc = marts.engagement_daily(w.stg_unity, w.as_of, incremental=True)
    sinks.append_new_columns(eng_inc, path, ["date"])
    sinks.append_new_columns(eng_inc, path, ["date"])  # a second run leaves the same table
    return sinks.read_evolving(w.spark, path, eng.schema)
