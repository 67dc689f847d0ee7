"""Raw source feeds derived from the test tables.

The reference reads four raw feeds (GA4 events, Adjust report, Unity analytics, Meta ads) and
two sheet lookups. The test data has none of these shapes, so each feed is derived here by
deterministic expressions (FIXTURES.md). Every derivation is narrow (no shuffle) except where a
feed is a grouped report (Unity, Meta) or needs a per-user value (first touch).

Money columns that feed sums are built from integer cents so Spark and the DuckDB oracle get
bit-identical inputs regardless of summation order.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.session import AS_OF

PARAM_VALUE = T.StructType([
    T.StructField("int_value", T.LongType()),
    T.StructField("double_value", T.DoubleType()),
    T.StructField("string_value", T.StringType()),
])
PARAM = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE)])
ACTION = T.StructType([T.StructField("action_type", T.StringType()),
                       T.StructField("value", T.DoubleType())])

# Fixed values of the fixture (FIXTURES.md): country by user_id % 6, report start day.
COUNTRIES = ("United States", "Germany", "Vietnam", "Brazil", "Croatia", None)
REPORT_START = _dt.date(2023, 12, 2)


def _kv(key: str, int_v: Column | None = None, dbl_v: Column | None = None,
        str_v: Column | None = None) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            (int_v if int_v is not None else F.lit(None)).cast("bigint").alias("int_value"),
            (dbl_v if dbl_v is not None else F.lit(None)).cast("double").alias("double_value"),
            (str_v if str_v is not None else F.lit(None)).cast("string").alias("string_value"),
        ).alias("value"),
    )


def _event_name(event_type: Column, event_id: Column) -> Column:
    m = event_id % 4
    table = {
        "signup": ("first_open", "new_player", "tutorial_step", "tutorial_completed"),
        "view": ("level_started", "level_started", "screen_view", "user_engagement"),
        "click": ("booster_used", "currency_earned", "currency_spent", None),
        "error": ("level_failed", "level_failed", "level_completed", "level_completed"),
        "purchase": ("iap_purchase", "in_app_purchase", "staff_level_purchase", "object_level_purchase"),
    }
    expr = None
    for et, names in table.items():
        for i, name in enumerate(names):
            if name is None:
                val = F.when(event_id % 8 == 3, F.lit("screen_change")).otherwise(F.lit("untracked_event"))
            else:
                val = F.lit(name)
            cond = (event_type == et) & (m == i)
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def _item(key: Column, popular: Column) -> Column:
    """Item of an upgrade: every third event buys one of ten popular items, the others range over the part keys
    (five events a part at every size), so items and their sheet grow with the tables."""
    return F.when(key % 3 == 0, popular).otherwise(F.floor(key / 5))


def raw_ga4_events(events: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """GA4 export rows (nested structs + event_params array) with a ``table_suffix`` column.

    Days before ``as_of`` form the finalized shards (suffix ``YYYYMMDD``); ``as_of`` itself is the
    intraday snapshot (suffix ``intraday_YYYYMMDD``).
    """
    first_touch = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    e = events.join(first_touch, "user_id", "left")

    eid, uid, val = F.col("event_id"), F.col("user_id"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("bigint")
    ts = F.col("ts").cast("timestamp")
    micros = F.unix_micros(ts)
    name = _event_name(F.col("event_type"), eid)
    dom = F.dayofmonth(ts)
    is_ios = (uid % 2) == 1

    e = e.select("*", name.alias("_name"), k.alias("_k"), micros.alias("_micros"),
                 F.date_format(ts, "yyyyMMdd").alias("_day"), dom.alias("_dom"))
    name, k, dom = F.col("_name"), F.col("_k"), F.col("_dom")

    is_level = name.isin("level_started", "level_completed", "level_failed")
    is_currency = name.isin("currency_earned", "currency_spent")
    is_iap = name.isin("iap_purchase", "in_app_purchase")
    is_tutorial = name.isin("tutorial_step", "tutorial_completed")
    entries = [
        F.when(is_level, _kv("level_id", int_v=60000 + k % 10)),
        _kv("ga_session_id", int_v=F.floor(F.col("_micros") / F.lit(21600000000)) * 100 + uid % 100),
        _kv("ga_session_number", int_v=1 + F.floor(dom / 5)),
        F.when(is_currency & (eid % 8 < 4), _kv("amount", dbl_v=val)),
        F.when(is_currency & (eid % 8 >= 4), _kv("amount", int_v=F.floor(val))),
        F.when(is_currency, _kv("currency_type",
                                str_v=F.when(k % 3 == 0, F.lit("Gems")).otherwise(F.lit("Coins")))),
        F.when(name == "currency_earned",
               _kv("reason", str_v=F.when(k % 2 == 0, F.lit("ChallengeWon")).otherwise(F.lit("ChallengeLost")))),
        F.when(name == "level_failed", _kv("reason", str_v=F.concat(F.lit("reason_"), (k % 4).cast("string")))),
        F.when(name == "iap_purchase",
               _kv("price_dollars", dbl_v=F.when(eid % 16 == 0, F.lit(0.0)).otherwise(val))),
        F.when(name == "in_app_purchase", _kv("price", int_v=F.floor(val))),
        F.when(name == "iap_purchase", _kv("price_gems", int_v=k)),
        F.when(is_iap, _kv("product_id", str_v=F.concat(F.lit("prod_"), (k % 4).cast("string")))),
        F.when(is_iap, _kv("item_name", str_v=F.concat(F.lit("prod_"), (k % 4).cast("string")))),
        F.when(name == "booster_used", _kv("booster_id", int_v=F.floor(F.col("event_id") / 5) + 1)),
        F.when(name == "staff_level_purchase", _kv("staff_id", int_v=_item(eid, 110 + k % 5))),
        F.when(name == "staff_level_purchase", _kv("staff_level", int_v=1 + eid % 10)),
        F.when(name == "object_level_purchase", _kv("object_id", int_v=_item(eid, 120 + k % 5))),
        F.when(name == "object_level_purchase", _kv("object_level", int_v=1 + eid % 10)),
        F.when(is_tutorial, _kv("tutorial_id", int_v=40000 + k % 3)),
        F.when(name == "tutorial_step", _kv("step_num", int_v=1 + k % 5)),
        F.when((name == "user_engagement") & (eid % 2 == 0), _kv("value", int_v=k)),
        F.when((name == "user_engagement") & (eid % 2 == 1), _kv("value", dbl_v=val)),
    ]
    params = F.filter(F.array(*entries), lambda x: x.isNotNull())

    country = None
    for i, c in enumerate(COUNTRIES):
        v = F.lit(c).cast("string")
        country = F.when(uid % 6 == i, v) if country is None else country.when(uid % 6 == i, v)

    as_of_s = as_of.strftime("%Y%m%d")
    suffix = F.when(F.col("_day") < F.lit(as_of_s), F.col("_day")).otherwise(
        F.concat(F.lit("intraday_"), F.col("_day")))
    const = lambda s: F.lit(s).cast("string")
    return e.select(
        F.col("_day").alias("event_date"),
        F.col("_micros").alias("event_timestamp"),
        name.alias("event_name"),
        F.when(name == "in_app_purchase", val).cast("double").alias("event_value_in_usd"),
        F.when(uid % 7 == 0, F.lit(None).cast("string")).otherwise(uid.cast("string")).alias("user_id"),
        F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("u"), uid.cast("string"))).alias("user_pseudo_id"),
        F.unix_micros(F.col("first_ts").cast("timestamp")).alias("user_first_touch_timestamp"),
        const("1234567890").alias("stream_id"),
        F.when(is_ios, F.lit("IOS")).otherwise(F.lit("ANDROID")).alias("platform"),
        F.struct(
            F.when(uid % 5 == 0, F.lit("tablet")).otherwise(F.lit("mobile")).alias("category"),
            F.when(is_ios, F.lit("Apple")).otherwise(F.lit("Google")).alias("mobile_brand_name"),
            F.concat(F.lit("model_"), (uid % 3).cast("string")).alias("mobile_model_name"),
            F.concat(F.lit("device_"), (uid % 3).cast("string")).alias("mobile_marketing_name"),
            F.concat(F.lit("hw_"), (uid % 3).cast("string")).alias("mobile_os_hardware_model"),
            F.when(is_ios, F.lit("iOS")).otherwise(F.lit("Android")).alias("operating_system"),
            F.when(is_ios, F.lit("iOS 17")).otherwise(F.lit("Android 14")).alias("operating_system_version"),
            const("en-us").alias("language"),
            const("No").alias("is_limited_ad_tracking"),
            F.lit(0).cast("bigint").alias("time_zone_offset_seconds"),
        ).alias("device"),
        F.struct(
            const("(not set)").alias("continent"),
            country.alias("country"),
            const("(not set)").alias("region"),
            const("(not set)").alias("city"),
            const("(not set)").alias("sub_continent"),
            const("(not set)").alias("metro"),
        ).alias("geo"),
        F.struct(
            const("com.example.game").alias("id"),
            F.when(dom < 11, F.lit("0.1.7")).when(dom < 21, F.lit("0.1.8")).otherwise(F.lit("0.1.10")).alias("version"),
            const("store").alias("install_store"),
            const("1:1234567890:app").alias("firebase_app_id"),
            F.when(uid % 3 == 0, F.lit("")).when(uid % 3 == 1, F.lit("store")).otherwise(
                F.lit(None).cast("string")).alias("install_source"),
        ).alias("app_info"),
        F.struct(
            const("(direct)").alias("name"),
            const("(none)").alias("medium"),
            F.when(uid % 4 == 0, F.lit("")).when(uid % 4 == 1, F.lit("google")).when(
                uid % 4 == 3, F.lit("facebook")).otherwise(F.lit(None).cast("string")).alias("source"),
        ).alias("traffic_source"),
        params.cast(T.ArrayType(PARAM)).alias("event_params"),
        suffix.alias("table_suffix"),
    )


def game_objects(part: DataFrame) -> DataFrame:
    """Sheet lookup (object_id, object_name): all parts but every 25th, which is missing on purpose."""
    return part.where(F.col("p_partkey") % 25 != 24).select(
        F.col("p_partkey").alias("object_id"), F.col("p_name").alias("object_name"))


def level_upgrade_recommendations(part: DataFrame) -> DataFrame:
    """Sheet lookup (level_id, item_id, upgrade_level): the distinct recommendations of all parts, every third for
    one of ten popular items, the others for the part itself."""
    pk = F.col("p_partkey")
    return part.select(
        (60000 + pk % 10).alias("level_id"),
        F.when(pk % 3 == 0, F.when(pk % 2 == 0, F.lit(110)).otherwise(F.lit(120)) + pk % 5).otherwise(pk)
         .cast("bigint").alias("item_id"),
        (1 + F.col("p_size") % 10).cast("bigint").alias("upgrade_level"),
    ).distinct()


# Adjust report columns the staging model passes through, by type; the ones the fixture
# does not derive are NULL.
ADJUST_STRING_COLS = ("app_token", "store_id", "store_type", "adgroup", "adgroup_id_network",
                      "source_network", "source_id_network", "creative", "creative_id_network",
                      "region", "device_type", "partner_name", "partner_id")
ADJUST_COUNT_COLS = ("network_installs", "non_organic_installs", "reinstalls", "first_reinstalls",
                     "reattributions", "reattribution_reinstalls", "uninstalls", "first_uninstalls",
                     "uninstall_cohort", "base_sessions", "waus", "maus", "attribution_clicks",
                     "network_clicks", "attribution_impressions", "network_impressions",
                     "paid_clicks", "paid_impressions", "ad_impressions")
ADJUST_MONEY_COLS = ("adjust_cost", "network_cost", "ecpi", "ecpi_all", "network_ecpi", "ecpc",
                     "ecpm", "network_ecpm", "click_cost", "impression_cost", "install_cost",
                     "ad_rpm", "arpdau", "arpdau_ad", "arpdau_iap", "return_on_investment",
                     "revenue_to_cost", "roas", "roas_ad", "roas_iap", "click_conversion_rate",
                     "ctr", "impression_conversion_rate")


def _geo_lineitems(lineitem, orders, customer, nation, region) -> DataFrame:
    """lineitem with its customer's segment and region name. nation/region are fixed 25/5-row
    dimensions, so broadcasting them is bounded; orders meet customers first, so line items shuffle once, on
    the order key."""
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name")
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    o = orders.select("o_orderkey", "o_custkey").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return lineitem.join(o.select("o_orderkey", "c_mktsegment", "r_name"), F.col("l_orderkey") == F.col("o_orderkey"))


def adjust_rows(lineitem, orders, customer, nation, region) -> DataFrame:
    """The narrow rows of the Adjust report, one per line item: what ``adjust_columns`` derives its columns from.
    Exchanges and sorts (the landing by day) handle these instead of the report's hundred columns."""
    li = _geo_lineitems(lineitem, orders, customer, nation, region)
    return li.select(
        F.date_add(F.lit(REPORT_START), (F.col("l_orderkey") % 60).cast("int")).alias("day"),
        (F.col("l_suppkey") % 2).alias("_app"), (F.col("l_partkey") % 3).alias("_campaign"),
        "c_mktsegment", "r_name", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax")


def adjust_report(lineitem, orders, customer, nation, region) -> DataFrame:
    """Adjust attribution report: one row per line item."""
    return adjust_columns(adjust_rows(lineitem, orders, customer, nation, region))


def adjust_columns(li: DataFrame) -> DataFrame:
    """The report's columns from ``adjust_rows``: a projection, no exchange."""
    qty, ln = F.col("l_quantity"), F.col("l_linenumber")
    installs = F.when(ln <= 4, qty).otherwise(F.lit(0.0)).cast("bigint")
    cost = F.when(ln == 1, F.lit(0.0)).when(ln == 2, F.lit(None).cast("double")).otherwise(
        F.col("l_extendedprice") * F.col("l_discount"))
    revenue = F.col("l_extendedprice") * F.col("l_tax")
    ad_revenue = F.col("l_extendedprice") * F.lit(0.01)
    base = li.select(
        "day",
        F.concat(F.lit("app_"), F.col("_app").cast("string")).alias("app"),
        F.concat(F.col("c_mktsegment"), F.lit("_"), F.col("l_returnflag")).alias("network"),
        F.concat(F.lit("cmp_"), F.col("_campaign").cast("string")).alias("campaign"),
        F.col("_campaign").cast("string").alias("campaign_id_network"),
        F.lower(F.col("r_name")).alias("country_code"),
        F.when(F.col("l_linestatus") == "O", F.lit("iOS")).otherwise(F.lit("Android")).alias("os_name"),
        F.col("c_mktsegment").alias("channel"),
        (qty * 100).cast("bigint").alias("impressions"),
        F.when(ln == 7, F.lit(0.0)).otherwise(qty * 10).cast("bigint").alias("clicks"),
        installs.alias("installs"),
        cost.alias("cost"),
        revenue.alias("revenue"),
        (revenue * F.lit(0.5)).alias("cohort_revenue"),
        ad_revenue.alias("ad_revenue"),
        (qty * 5).cast("bigint").alias("daus"),
        (qty * 8).cast("bigint").alias("sessions"),
        (qty * 20).cast("bigint").alias("events"),
    )
    paid = F.coalesce(F.col("cost"), F.lit(0.0)) > 0
    out = base.select(
        "*",
        F.when(paid, F.col("installs")).otherwise(F.lit(0).cast("bigint")).alias("paid_installs"),
        (F.col("installs") - F.when(paid, F.col("installs")).otherwise(F.lit(0).cast("bigint"))).alias("organic_installs"),
        (F.col("installs") / 4).cast("bigint").alias("revenue_events"),
        (F.col("revenue") + F.col("ad_revenue")).alias("all_revenue"),
        (F.col("revenue") + F.col("ad_revenue") - F.coalesce(F.col("cost"), F.lit(0.0))).alias("gross_profit"),
    )
    nulls = ([F.lit(None).cast("string").alias(c) for c in ADJUST_STRING_COLS]
             + [F.lit(None).cast("bigint").alias(c) for c in ADJUST_COUNT_COLS]
             + [F.lit(None).cast("double").alias(c) for c in ADJUST_MONEY_COLS])
    return out.select("*", *nulls)


def unity_analytics_daily(orders, customer, nation, region) -> DataFrame:
    """Unity analytics report: one row per (day, country, platform, clientVersion)."""
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name")
    cust = customer.select("c_custkey", "c_nationkey").join(
        F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    rows = o.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.date_add(F.lit(REPORT_START), (F.col("o_orderkey") % 60).cast("int")).alias("day"),
        F.lower(F.col("r_name")).alias("country"),
        F.when(F.col("o_orderstatus") == "O", F.lit("iOS"))
         .when(F.col("o_orderstatus") == "F", F.lit("Android"))
         .otherwise(F.lit("MAC_CLIENT")).alias("platform"),
        F.col("o_orderpriority").alias("clientVersion"),
        F.floor(F.col("o_totalprice") * 100 + F.lit(0.5)).cast("bigint").alias("cents"),
        F.col("o_totalprice"),
    )
    g = rows.groupBy("day", "country", "platform", "clientVersion").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_totalprice") > 250000).alias("payers"),
        F.sum("cents").alias("cents"),
    )
    dom = F.dayofmonth("day")
    n = F.col("n")
    total = F.col("cents") / F.lit(100000.0)
    return g.select(
        "day", "country", "platform", "clientVersion",
        F.lit("organic").alias("acquisitionChannel"),
        (n * 10).alias("uniqueUsers"), n.alias("newUsers"),
        (n * 30).alias("WAU"), (n * 80).alias("MAU"),
        F.lit(None).cast("string").alias("newVsReturning"),
        total.alias("totalRevenue"), (total * F.lit(0.6)).alias("iapRevenue"),
        F.lit(None).cast("double").alias("ARPDAU"), F.lit(None).cast("double").alias("ARPPU"),
        F.col("payers"),
        F.lit(None).cast("double").alias("revenuePerTransaction"),
        (n * 2).alias("totalTransactions"),
        (F.lit(0.4) + (dom % 5) / F.lit(100.0)).alias("d1Retention"),
        (F.lit(0.2) + (dom % 5) / F.lit(100.0)).alias("d7Retention"),
        (F.lit(0.1) + (dom % 5) / F.lit(100.0)).alias("d30Retention"),
        (n * 15).alias("numberOfSessions"),
        (F.lit(1.5) + dom / F.lit(100.0)).alias("sessionsPerUser"),
        (F.lit(300.0) + dom).alias("averageSessionLength"),
        (F.lit(600.0) + dom * 2).alias("playTimePerUser"),
    )


def _action_array(*pairs) -> Column:
    return F.array(*[F.struct(F.lit(t).alias("action_type"), v.cast("double").alias("value"))
                     for t, v in pairs]).cast(T.ArrayType(ACTION))


def _meta_report(lineitem: DataFrame, grain: str) -> DataFrame:
    """Meta ads report grouped by (day, ``grain`` id) with actions arrays."""
    key = F.col("l_partkey") % (25 if grain == "ad" else 5)
    rows = lineitem.select(
        F.date_add(F.lit(REPORT_START), (F.col("l_orderkey") % 60).cast("int")).alias("date_start"),
        key.alias("_id"),
        F.col("l_quantity"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("bigint").alias("spend_cents"),
        F.floor(F.col("l_extendedprice") * F.col("l_tax") * 100).cast("bigint").alias("value_cents"),
    )
    g = rows.groupBy("date_start", "_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("qty"),
        F.sum("spend_cents").alias("spend_cents"),
        F.sum("value_cents").alias("value_cents"),
    )
    i, qty, n = F.col("_id"), F.col("qty"), F.col("n")
    spend = F.col("spend_cents") / F.lit(100.0)
    no_actions = i == 24 if grain == "ad" else F.lit(False)
    actions = F.when(~no_actions, _action_array(
        ("mobile_app_install", qty),
        ("link_click", qty * 3),
        ("link_click", qty * 2),
        ("app_custom_event.fb_mobile_purchase", n),
    ))
    purchase = lambda v: _action_array(("app_custom_event.fb_mobile_purchase", v))
    video = lambda v: _action_array(("video_view", v))
    camp = i if grain == "campaign" else i % 5
    cols = [
        "date_start",
        (i % 2).cast("bigint").alias("account_id"),
        F.concat(F.lit("account_"), (i % 2).cast("string")).alias("account_name"),
        F.lit("USD").alias("account_currency"),
        camp.cast("bigint").alias("campaign_id"),
        F.concat(F.lit("campaign_"), camp.cast("string")).alias("campaign_name"),
    ]
    if grain == "ad":
        cols += [
            (i % 10).cast("bigint").alias("adset_id"),
            F.concat(F.lit("adset_"), (i % 10).cast("string")).alias("adset_name"),
            i.cast("bigint").alias("ad_id"),
            F.concat(F.lit("ad_"), i.cast("string")).alias("ad_name"),
        ]
    else:
        cols += [F.lit("APP_INSTALLS").alias("objective"), F.lit("AUCTION").alias("buying_type")]
    null_d = lambda c: F.lit(None).cast("double").alias(c)
    null_l = lambda c: F.lit(None).cast("bigint").alias(c)
    null_a = lambda c: F.lit(None).cast(T.ArrayType(ACTION)).alias(c)
    cols += [
        F.lit("7d_click").alias("attribution_setting"),
        (qty * 100).cast("bigint").alias("impressions"),
        (qty * 60).cast("bigint").alias("reach"),
        null_d("frequency"), null_l("full_view_impressions"), null_l("full_view_reach"),
        (qty * 10).cast("bigint").alias("clicks"),
        (qty * 5).cast("bigint").alias("inline_link_clicks"),
        (qty * 4).cast("bigint").alias("unique_clicks"),
        null_l("unique_inline_link_clicks"), null_l("inline_post_engagement"),
        spend.alias("spend"),
        null_d("social_spend"), null_d("cpm"), null_d("cpc"), null_d("cpp"), null_d("ctr"),
        null_d("unique_ctr"), null_d("inline_link_click_ctr"), null_d("unique_inline_link_click_ctr"),
        actions.alias("actions"),
        purchase(F.col("value_cents") / F.lit(100.0)).alias("action_values"),
        null_a("unique_actions"), null_a("cost_per_action_type"), null_a("purchase_roas"),
        purchase(F.lit(1.5) + i / F.lit(10.0)).alias("mobile_app_purchase_roas"),
    ]
    if grain == "ad":
        cols += [
            video(qty * 40).alias("video_play_actions"),
            video(qty * 10).alias("video_thruplay_watched_actions"),
            video(qty * 30).alias("video_p25_watched_actions"),
            video(qty * 20).alias("video_p50_watched_actions"),
            video(qty * 15).alias("video_p75_watched_actions"),
            video(qty * 10).alias("video_p100_watched_actions"),
            video(F.lit(12.5) + i).alias("video_avg_time_watched_actions"),
        ]
    return g.select(*cols)


def meta_ads_ad_daily(lineitem: DataFrame) -> DataFrame:
    return _meta_report(lineitem, "ad")


def meta_ads_campaign_daily(lineitem: DataFrame) -> DataFrame:
    return _meta_report(lineitem, "campaign")
