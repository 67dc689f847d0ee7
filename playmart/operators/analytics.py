"""Player-behaviour models (A0-A22) over ``stg_events``.

Per-user ordered windows use the segmented scans of ``playmart.functions.scans`` so a hot
player is spread over time segments; "first row per group" is a min aggregate joined back;
active-day ranks are computed over distinct (user, day) pairs. The lookups (``game_objects``,
``level_upgrade_recommendations``) are sheets; their joins are left to AQE, which broadcasts
them from the measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.functions.columns import IAP_EVENT_NAMES, iap_value_usd, is_iap_revenue_event, not_test_country
from playmart.functions.scans import (dense_rank_by_day, record_steps, segmented_fill, segmented_lag,
                                      segmented_row_number)
from playmart.operators.players import player_facts, spender_segment

USER = "user_pseudo_id"


def _not_noise():
    return ~F.col("event_name").isin("user_engagement", "screen_change")


def level_attribution(df: DataFrame, with_current: bool = True, out: str = "attributed_level") -> DataFrame:
    """A0: previous = last non-null level up to the row, next = first non-null level from the row
    on (per user, by timestamp); ``out`` = coalesce(previous, level, next), or coalesce(previous,
    next) when ``with_current`` is False."""
    d = segmented_fill(df, "level_id")
    terms = [F.col("previous_level_id")] + ([F.col("level_id")] if with_current else []) + [F.col("next_level_id")]
    return d.withColumn(out, F.coalesce(*terms))


def _named(events: DataFrame, *names: str) -> DataFrame:
    return events.where(F.col("event_name").isin(*names))


def avg_time_spent(events: DataFrame) -> DataFrame:
    """A1: whole minutes since the user's previous level event, summed on completed/failed rows."""
    e = _named(events, "level_started", "level_completed", "level_failed").where(not_test_country()).select(
        USER, "app_version", "event_date", "geo_country", "level_id", "event_name", "event_timestamp")
    e = segmented_lag(e, "event_timestamp", "_prev_ts")
    e = e.withColumn("playtime", F.timestamp_diff("MINUTE", F.col("_prev_ts"), F.col("event_timestamp")))
    return (e.where(F.col("event_name").isin("level_completed", "level_failed"))
             .groupBy("app_version", "geo_country", "level_id", USER, "event_date")
             .agg(F.sum("playtime").alias("total_playtime")))


def iap_players(events: DataFrame) -> DataFrame:
    """Distinct users with a paid ``iap_purchase``."""
    return events.where((F.col("price_dollars") > 0) & (F.col("event_name") == "iap_purchase")).select(USER).distinct()


def boosters_usage(events: DataFrame, game_objects: DataFrame) -> DataFrame:
    """A2: one row per booster_used event with payer flag, booster name and attributed level."""
    payers = iap_players(events).withColumn("_payer", F.lit(1))
    b = _named(events, "booster_used", "level_started").select(
        "app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name", "level_id", "booster_id")
    b = b.join(payers, USER, "left").withColumn("iap_players", F.coalesce(F.col("_payer"), F.lit(0))).drop("_payer")
    b = level_attribution(b, out="_lvl")
    b = b.where(F.col("event_name") == "booster_used")
    b = b.join(game_objects, b.booster_id == game_objects.object_id, "inner")
    return b.select("app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name",
                    "iap_players", "booster_id", "object_name", F.col("_lvl").alias("level_id"))


def _new_player_versions(events: DataFrame) -> DataFrame:
    """(app_version, user, times): a new_player row that repeats multiplies amounts joined to it, as
    in the reference; counting it first keeps one row per (version, user) in the join."""
    return _named(events, "new_player").groupBy("app_version", USER).agg(F.count("*").alias("_times"))


def _coins_log(events: DataFrame, version_from_new_player: bool) -> DataFrame:
    nu = _new_player_versions(events).select(F.col("app_version").alias("_nv"), F.col(USER).alias("_nu"), "_times")
    e = _named(events, "currency_earned", "currency_spent", "level_started").where(not_test_country())
    e = e.join(nu, (F.col(USER) == F.col("_nu")) & (F.col("app_version") == F.col("_nv")), "inner")
    e = e.select(F.col("_nv").alias("app_version") if version_from_new_player else "app_version",
                 "geo_country", USER, "event_date", "event_timestamp", "event_name", "level_id",
                 "currency_type", "reason", (F.col("amount") * F.col("_times")).alias("amount"))
    e = level_attribution(e, out="_lvl")
    return e.where((F.col("currency_type") == "Coins")
                   & F.col("event_name").isin("currency_earned", "currency_spent"))


def _earned_spent(df: DataFrame, keys: list[str]) -> DataFrame:
    earned = F.sum(F.when(F.col("event_name") == "currency_earned", F.col("total_amount")))
    spent = F.sum(F.when(F.col("event_name") == "currency_spent", F.col("total_amount")))
    return df.groupBy(*keys).agg(
        earned.alias("earned_amount"), spent.alias("spent_amount"),
        (F.coalesce(earned, F.lit(0.0)) - F.coalesce(spent, F.lit(0.0))).alias("sub_total_amount"))


def coins_balance(events: DataFrame) -> DataFrame:
    """A3: per (version, level, user, date) coin subtotal and the user's running balance ordered
    by (version, level, date); rows with a positive balance. ``event_date`` breaks the reference's
    order ties (several dates per level)."""
    g = _coins_log(events, True).where(F.col("_lvl").isNotNull()).drop("level_id").withColumnRenamed("_lvl", "level_id")
    g = g.groupBy("app_version", "level_id", "event_name", USER, "event_date").agg(F.sum("amount").alias("total_amount"))
    b = _earned_spent(g, ["app_version", "level_id", USER, "event_date"])
    w = Window.partitionBy(USER).orderBy("app_version", "level_id", "event_date").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("cumulative_sum", F.sum("sub_total_amount").over(w))
    return b.where(F.col("cumulative_sum") > 0).select(
        "app_version", "level_id", USER, "event_date", "sub_total_amount", "cumulative_sum")


def coins_balance_level(events: DataFrame) -> DataFrame:
    """A4: distinct users whose running coin balance at (version, level) grain goes below zero."""
    g = _coins_log(events, False).where(F.col("_lvl").isNotNull()).withColumnRenamed("_lvl", "attributed_level")
    g = g.groupBy("app_version", "attributed_level", "event_name", USER).agg(F.sum("amount").alias("total_amount"))
    b = _earned_spent(g, ["app_version", "attributed_level", USER])
    w = Window.partitionBy(USER).orderBy("app_version", "attributed_level").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("cumulative_sum", F.sum("sub_total_amount").over(w))
    return b.where(F.col("cumulative_sum") < 0).select(USER).distinct()


def _challenge_coins(events: DataFrame, reason: str) -> DataFrame:
    e = _named(events, "currency_earned", "level_started").select(
        "app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name", "level_id",
        "currency_type", "reason", "amount")
    e = level_attribution(e, out="_lvl")
    return e.where((F.col("currency_type") == "Coins") & (F.col("event_name") == "currency_earned")
                   & (F.col("reason") == reason))


def coins_earned_failed(events: DataFrame) -> DataFrame:
    """A5: coins earned with reason ChallengeLost per (version, level, event, date, user, geo)."""
    g = _challenge_coins(events, "ChallengeLost")
    return g.groupBy("app_version", F.col("_lvl").alias("level_id"), "event_name", "event_date", USER,
                     "geo_country").agg(F.sum("amount").alias("sum_amount"))


def _first_per_group(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose timestamp is the minimum of their group (ties kept), i.e. DENSE_RANK() = 1.
    A min aggregate plus a join instead of a window, so a hot group never sits in one task."""
    firsts = df.groupBy(*keys).agg(F.min("event_timestamp").alias("_first_ts")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first_ts")
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    cond.append(F.col("event_timestamp") == F.col("_first_ts"))
    return df.join(firsts, cond, "left_semi")


def coins_earned_won(events: DataFrame) -> DataFrame:
    """The first ChallengeWon coin reward per (version, user, attributed level), ties kept."""
    g = _challenge_coins(events, "ChallengeWon").withColumnRenamed("_lvl", "lvl")
    f = _first_per_group(g, ["app_version", USER, "lvl"])
    return f.select("app_version", F.col("lvl").alias("level_id"), "event_name", USER, "geo_country",
                    "event_date", F.col("amount").alias("total_amount"))


def _bucket(c) -> F.Column:
    return (F.ceil(c / 100) * 100).cast("double")


def coins_earned_won_count(events: DataFrame) -> DataFrame:
    """Users by bucket (ceil(amount / 100) * 100) of their first ChallengeWon reward."""
    g = _challenge_coins(events, "ChallengeWon").withColumnRenamed("_lvl", "attributed_level")
    f = _first_per_group(g, ["app_version", USER, "attributed_level"])
    return f.groupBy("app_version", "geo_country", "attributed_level", "event_name", "event_date",
                     _bucket(F.col("amount")).alias("coins_amount_bucket")).agg(
        F.countDistinct(USER).alias("user_count"))


def coins_failed_count(events: DataFrame) -> DataFrame:
    """Users by bucket of their summed ChallengeLost coins per (version, level, event, date)."""
    g = _challenge_coins(events, "ChallengeLost").withColumnRenamed("_lvl", "attributed_level")
    per_user = g.groupBy("app_version", "attributed_level", "event_name", "event_date", USER, "geo_country").agg(
        _bucket(F.sum("amount")).alias("coins_amount_bucket"))
    return per_user.groupBy("app_version", "geo_country", "attributed_level", "event_name", "event_date",
                            "coins_amount_bucket").agg(F.countDistinct(USER).alias("user_count"))


def completed_players(events: DataFrame) -> DataFrame:
    """Distinct completers per (version, level, geo, date)."""
    e = _named(events, "level_completed").where(not_test_country() & F.col("app_version").isNotNull())
    return e.groupBy("app_version", "level_id", "geo_country", "event_date").agg(
        F.countDistinct(USER).alias("users_count"))


def earned_spent_analysis(events: DataFrame, game_objects: DataFrame) -> DataFrame:
    """A10: economy event log with attributed level, upgrade name/level and
    ``iap_value = coalesce(price_dollars, price_gems)`` (mixes USD and gems, as the reference)."""
    e = _named(events, "currency_earned", "currency_spent", "level_started", "iap_purchase",
               "object_level_purchase", "staff_level_purchase").select(
        "app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name", "level_id",
        "reason", "amount", "item_name",
        F.coalesce(F.col("price_dollars"), F.col("price_gems").cast("double")).alias("iap_value"),
        F.coalesce("object_level", "staff_level").alias("upgrade_level"),
        F.coalesce("object_id", "staff_id").alias("upgrade_id"))
    e = level_attribution(e)
    e = e.join(game_objects, e.upgrade_id == game_objects.object_id, "left")
    return e.select("app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name",
                    "attributed_level", F.col("object_name").alias("upgrade_name"), "upgrade_level",
                    "iap_value", "reason", "amount", "item_name")


def fail_rate(events: DataFrame) -> DataFrame:
    """Distinct starters and failers per (version, geo, date, level).

    Two-level aggregate instead of two COUNT(DISTINCT CASE ...): first one row per (keys, user)
    with started/failed flags, then sums. No Expand, one shuffle per level."""
    keys = ["app_version", "geo_country", "event_date", "level_id"]
    e = _named(events, "level_started", "level_completed", "level_failed").where(not_test_country())
    per_user = e.groupBy(*keys, USER).agg(
        F.max(F.when(F.col("event_name") == "level_started", 1).otherwise(0)).alias("_s"),
        F.max(F.when(F.col("event_name") == "level_failed", 1).otherwise(0)).alias("_f"))
    return per_user.groupBy(*keys).agg(F.sum("_s").cast("bigint").alias("user_started"),
                                       F.sum("_f").cast("bigint").alias("user_failed"))


def fail_reasons(events: DataFrame) -> DataFrame:
    """Distinct users per (version, geo, date, level, fail reason)."""
    e = _named(events, "level_failed").where(not_test_country())
    return e.groupBy("app_version", "geo_country", "event_date", "level_id",
                     F.col("reason").alias("fail_reason")).agg(F.countDistinct(USER).alias("users_count"))


def _histogram(events: DataFrame, event_name: str, count_name: str) -> DataFrame:
    e = _named(events, event_name).where(not_test_country())
    per_user = e.groupBy("app_version", "geo_country", "event_date", USER, "level_id").agg(
        F.count(F.lit(1)).alias(count_name))
    return per_user.groupBy("app_version", "geo_country", "level_id", count_name, "event_date").agg(
        F.countDistinct(USER).alias("users_count"))


def fails_count(events: DataFrame) -> DataFrame:
    """Users per number of fails per (version, geo, level, day)."""
    return _histogram(events, "level_failed", "fails_count")


def tries_count(events: DataFrame) -> DataFrame:
    """Users per number of starts per (version, geo, level, day)."""
    return _histogram(events, "level_started", "tries_count")


def iap_ltv(events: DataFrame) -> DataFrame:
    """``price_dollars`` per (version, geo, product, date, level) over purchase and level-start
    rows whose ``ga_session_id`` also carries a paid purchase (the id alone, across users)."""
    e = _named(events, "iap_purchase", "level_started").where(not_test_country()).select(
        "app_version", USER, "geo_country", "event_date", "ga_session_id", "event_timestamp", "level_id",
        "event_name", "product_id", F.col("price_dollars").alias("event_value_in_usd"))
    paid_sessions = e.where(F.col("event_value_in_usd") > 0).select("ga_session_id").distinct()
    a = level_attribution(e, with_current=False, out="_lvl")
    a = a.join(paid_sessions, "ga_session_id", "left_semi")
    return a.groupBy("app_version", "geo_country", "product_id", "event_date",
                     F.col("_lvl").alias("level_id")).agg(F.sum("event_value_in_usd").alias("level_ltv"))


def iap_overview(events: DataFrame) -> DataFrame:
    """Event timeline with purchase flag, purchase ordinal and 1-based active day.
    ``user_pseudo_id`` comes from the purchase side (NULL on non-purchase rows), as in the reference."""
    paid = events.where((F.col("price_dollars") > 0) & (F.col("event_name") == "iap_purchase")).select(
        F.col(USER).alias("_pu"), F.col("event_timestamp").alias("_pts")).distinct()
    # DENSE_RANK by timestamp = row number over the distinct purchase timestamps of the user
    paid = segmented_row_number(paid, "iap_index", key_col="_pu", ts_col="_pts")
    e = events.where(_not_noise()).select("app_version", USER, "event_date", "event_timestamp", "product_id",
                                       "price_dollars")
    e = dense_rank_by_day(e)
    j = e.join(paid, (e[USER] == paid._pu) & (e.event_timestamp == paid._pts), "left")
    return j.select("app_version", F.col("_pu").alias(USER), "event_date", "event_timestamp", "product_id",
                    "price_dollars",
                    F.when(F.col("event_timestamp") == F.col("_pts"), 1).otherwise(0).alias("is_purchase"),
                    "iap_index", "active_day")


def level_start_per_user(events: DataFrame) -> DataFrame:
    """``count(level_id)`` of level starts per (version, level, user, geo, date)."""
    e = _named(events, "level_started").where(not_test_country())
    return e.groupBy("app_version", "geo_country", "level_id", USER, "event_date").agg(
        F.count("level_id").alias("level_starts_count"))


def max_level_active_day(events: DataFrame) -> DataFrame:
    """Max level per (version, geo, user, date, 0-based active day); the rank is taken over
    all non-noise events, before the test-country filter."""
    e = events.where(_not_noise()).select("app_version", "geo_country", USER, "event_date", "level_id")
    days = dense_rank_by_day(e.select(USER, "event_date").distinct()).withColumn("active_day", F.col("active_day") - 1)
    best = (e.where(not_test_country() & F.col(USER).isNotNull() & F.col("level_id").isNotNull())
            .groupBy("app_version", "geo_country", USER, "event_date").agg(F.max("level_id").alias("max_level_day")))
    return best.join(days, [USER, "event_date"]).select("app_version", "geo_country", USER, "event_date", "active_day",
                                                        "max_level_day")


def retention_abandonment_rate(events: DataFrame) -> DataFrame:
    """Per (new_player version, completion date, level): completers, the previous level's
    completers, the pool at level 60000 and abandoned = max(previous - current, 0)."""
    nu = _new_player_versions(events).select("app_version", F.col(USER).alias("_nu"))
    c = _named(events, "level_completed").select(USER, "event_date", "level_id").distinct()
    lc = c.join(nu, c[USER] == nu._nu).groupBy("app_version", F.col("event_date").alias("cohort_date"),
                                               "level_id").agg(F.countDistinct(USER).alias("users_completed"))
    pool = lc.where(F.col("level_id") == 60000).select("app_version", "cohort_date",
                                                       F.col("users_completed").alias("_pool"))
    w = Window.partitionBy("app_version", "cohort_date").orderBy("level_id")
    wl = lc.withColumn("_prev", F.lag("users_completed").over(w))
    out = wl.join(pool, ["app_version", "cohort_date"], "left")
    prev = F.coalesce(F.col("_prev"), F.lit(0).cast("bigint"))
    return out.select("app_version", "cohort_date", "level_id", "users_completed",
                      F.coalesce(F.col("_pool"), F.lit(0).cast("bigint")).alias("pool_count"),
                      prev.alias("prev_level_users"),
                      F.greatest(prev - F.col("users_completed"), F.lit(0).cast("bigint")).alias("users_abandoned"))


RETENTION_DAYS = (1, 3, 7, 14, 30)


def retention_cohorts(events: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """(cohort date, geo, acquisition source, version, spender segment) -> cohort size, IAP
    value and users active exactly 1/3/7/14/30 days after the cohort date (no elapsed-day guard).

    The cohort row is the user's least first_open/new_player event (``player_facts``, or the maintained
    ``players``); activity is distinct per (user, day) and each user has one cohort row, so a
    conditional count equals the distinct count and no Expand is needed."""
    keys = ["cohort_date", "geo_country", "acquisition_source", "app_version", "spender_segment"]
    players = player_facts(events) if players is None else players
    users = players.where(F.col("touch").isNotNull()).select(
        USER, "touch.cohort_date", "touch.geo_country", "touch.acquisition_source", "touch.app_version",
        spender_segment().alias("spender_segment"), F.col("iap_value_usd").alias("total_iap_value_usd"))
    activity = events.select(USER, "event_date").distinct()
    offset = F.datediff(F.col("event_date"), F.col("cohort_date"))
    base = users.join(activity, USER).where(offset.between(0, 30))
    metrics = base.groupBy(*keys).agg(*[F.count_if(offset == n).alias(f"retained_d{n}_users") for n in RETENTION_DAYS])
    sizes = users.groupBy(*keys).agg(F.countDistinct(USER).alias("cohort_size"),
                                     F.sum("total_iap_value_usd").alias("total_iap_value_usd"))
    return sizes.join(metrics, keys, "left").select(
        *keys, "cohort_size", "total_iap_value_usd", *[f"retained_d{n}_users" for n in RETENTION_DAYS])


UPGRADE_EVENTS = ("staff_level_purchase", "object_level_purchase")


def recommended_steps(recommendations: DataFrame) -> DataFrame:
    """One row per item of the sheet: ``recs``, the record highs of its recommended upgrade by level in ascending
    order, as structs (level, upgrade). What is recommended at a level is the last entry at or below it. An item has
    at most one entry per distinct upgrade level, so the array is bounded by the game's content, not by rows."""
    steps = record_steps(recommendations, ["item_id"], "level_id", "upgrade_level")
    return steps.groupBy("item_id").agg(F.sort_array(F.collect_list(
        F.struct(F.col("_from").alias("level"), F.col("upgrade_level").alias("upgrade")))).alias("recs"))


def upgrades_analysis(events: DataFrame, recommendations: DataFrame, min_version: str = "0.1.8") -> DataFrame:
    """For each (version, user, level) last fail on a level of the sheet and each item the user had bought by
    then, the highest upgrade bought against the highest one recommended for the item at or below the level.
    ``app_version >= '0.1.8'`` is a string compare ('0.1.10' is below it), as in the reference. A purchase at the
    moment of the fail counts; rows without item, upgrade level or moment match nothing.

    The reference joins every purchase to every later fail of the user and the sheet to itself on ``level >= level``.
    Here purchases reduce to the record highs per (user, item), each valid until the next one, limited to the sheet's
    items and carrying their recommendations; fails reduce to the last per key, limited to the sheet's levels. What
    meets is at most one row per purchase and per fail, a user's rows are bounded by items, levels and versions
    however many events they own, and the interval join gives exactly the result's rows."""
    v = F.col("app_version") >= F.lit(min_version)
    fails = _named(events, "level_failed").where(v).groupBy("app_version", USER, "level_id").agg(
        F.max("event_timestamp").alias("event_timestamp"))
    fails = fails.join(recommendations.select("level_id").distinct(), "level_id", "left_semi")
    purchases = _named(events, *UPGRADE_EVENTS).where(v).select(
        USER, "event_timestamp", F.coalesce("staff_id", "object_id").alias("item_id"),
        F.coalesce("staff_level", "object_level").alias("upgrade_level"))
    steps = record_steps(purchases, [USER, "item_id"], "event_timestamp", "upgrade_level")
    steps = steps.join(recommended_steps(recommendations), "item_id")
    f, s = fails.alias("f"), steps.alias("s")
    at = F.col("f.event_timestamp")
    j = f.join(s, (F.col(f"f.{USER}") == F.col(f"s.{USER}")) & (F.col("s._from") <= at)
               & (F.col("s._to").isNull() | (at < F.col("s._to")))
               & (F.col("s.recs")[0]["level"] <= F.col("f.level_id")))
    below = F.filter("s.recs", lambda r: r["level"] <= F.col("f.level_id"))
    rec = F.element_at(below, -1)["upgrade"]
    return j.select(
        "f.app_version", f"f.{USER}", "f.level_id", "s.item_id", "s.upgrade_level",
        F.col("f.level_id").alias("recommended_level_id"), F.col("s.item_id").alias("recommended_item_id"),
        rec.alias("recommended_upgrade_level"),
        F.when(F.col("s.upgrade_level") >= rec, F.lit("pass")).otherwise(F.lit("fail")).alias("follow_recommendation"))


def upgrades_level(events: DataFrame, game_objects: DataFrame) -> DataFrame:
    """One row per upgrade purchase with item name and attributed level."""
    e = _named(events, "level_started", *UPGRADE_EVENTS).select(
        "app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name", "level_id",
        F.coalesce("staff_id", "object_id").alias("item_id"),
        F.coalesce("staff_level", "object_level").alias("upgrade_level"))
    e = level_attribution(e, out="_lvl")
    e = e.join(game_objects, e.item_id == game_objects.object_id, "left").where(F.col("event_name").isin(*UPGRADE_EVENTS))
    return e.select("app_version", "geo_country", USER, "event_date", "event_timestamp", "event_name", "item_id",
                    "object_id", "object_name", F.col("object_name").alias("item_name"), "upgrade_level",
                    F.col("_lvl").alias("level_id"))


def level_attribution_events(events: DataFrame) -> DataFrame:
    """A0 as a query: economy and booster events attributed to a level."""
    e = _named(events, "level_started", "booster_used", "currency_earned", "currency_spent").select(
        USER, "event_timestamp", "event_name", "level_id")
    return level_attribution(e)
