"""Metric recipes and consumer queries (R1-R19) over the marts.

Rule of the marts: a rate is never averaged. Every ratio here is recomputed from the sum of its
numerator and the sum of its denominator at the requested grain (``metric_rollup``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.functions.columns import not_test_country, safe_divide
from playmart.session import AS_OF

NOISE3 = ("user_engagement", "screen_change", "screen_view")


def _since(df: DataFrame, days: int, as_of: _dt.date, col: str = "date") -> DataFrame:
    return df.where(F.col(col) >= F.date_sub(F.lit(as_of), days))


def roas_by_network(ua: DataFrame, as_of: _dt.date = AS_OF, days: int = 14) -> DataFrame:
    """R1 (headline): spend, cohort revenue and ROAS by network over the last ``days`` days,
    ordered by spend."""
    g = _since(ua, days, as_of).groupBy("network").agg(
        F.sum("spend").alias("spend"), F.sum("cohort_revenue").alias("revenue"))
    return g.withColumn("roas", safe_divide(F.col("revenue"), F.col("spend"))).orderBy(F.desc_nulls_last("spend"))


def overview_slice(overview: DataFrame, platform: str = "ios", country: str = "AMERICA",
                   as_of: _dt.date = AS_OF, days: int = 14) -> DataFrame:
    """R2: overview rows for one platform and country over the last ``days`` days, by date."""
    return _since(overview.where((F.col("platform") == platform) & (F.col("country") == country)),
                  days, as_of).orderBy("date")


def roas_by_country_daily(ua: DataFrame, country: str = "AMERICA", platform: str = "ios",
                          as_of: _dt.date = AS_OF, days: int = 14) -> DataFrame:
    """R3 (recipe A): daily spend, revenue and ROAS for one country and platform."""
    g = _since(ua.where((F.col("country") == country) & (F.col("platform") == platform)), days, as_of)
    g = g.groupBy("date").agg(F.sum("spend").alias("spend"), F.sum("cohort_revenue").alias("revenue"))
    return g.withColumn("roas", safe_divide(F.col("revenue"), F.col("spend"))).orderBy("date")


def top_campaigns_by_spend(ua: DataFrame, as_of: _dt.date = AS_OF, days: int = 7, k: int = 10) -> DataFrame:
    """R4 (recipe B): top ``k`` (network, campaign) by spend with eCPI, ARPDAU and ROAS.
    Ties on spend break on (network, campaign) so the top-k set is deterministic."""
    g = _since(ua, days, as_of).groupBy("network", "campaign").agg(
        F.sum("spend").alias("spend"), F.sum("installs").alias("installs"),
        F.sum("revenue").alias("_rev"), F.sum("daus").alias("_daus"), F.sum("cohort_revenue").alias("_coh"))
    g = g.select("network", "campaign", "spend", "installs",
                 safe_divide(F.col("spend"), F.col("installs")).alias("ecpi"),
                 safe_divide(F.col("_rev"), F.col("_daus")).alias("arpdau"),
                 safe_divide(F.col("_coh"), F.col("spend")).alias("roas"))
    return g.orderBy(F.desc_nulls_last("spend"), "network", "campaign").limit(k)


def retention_trend(eng: DataFrame, as_of: _dt.date = AS_OF, days: int = 30) -> DataFrame:
    """R5 (recipe C): game-wide DAU-weighted D1/D7/D30 retention per day."""
    g = _since(eng, days, as_of).groupBy("date").agg(
        *[F.sum(F.col(m) * F.col("dau")).alias(f"_{m}") for m in ("d1_retention", "d7_retention", "d30_retention")],
        F.sum("dau").alias("_dau"))
    return g.select("date", *[safe_divide(F.col(f"_{m}"), F.col("_dau")).alias(m)
                              for m in ("d1_retention", "d7_retention", "d30_retention")]).orderBy("date")


def ua_funnel_campaign(funnel: DataFrame, campaign: str = "cmp_1", as_of: _dt.date = AS_OF,
                       days: int = 7) -> DataFrame:
    """R6 (recipe D): one campaign's acquisition funnel over the last ``days`` days (one row)."""
    f = _since(funnel.where(F.col("campaign") == campaign), days, as_of)
    g = f.agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
              F.sum("installs").alias("installs"), F.sum("revenue_events").alias("purchases"))
    c = F.col
    return g.select("*", safe_divide(c("clicks"), c("impressions")).alias("impr_to_click"),
                    safe_divide(c("installs"), c("clicks")).alias("click_to_install"),
                    safe_divide(c("purchases"), c("installs")).alias("install_to_purchase"))


def cohort_retention_curve(cohorts: DataFrame, geo: str = "United States") -> DataFrame:
    """R7 (recipe E): cohort size and D1..D30 retention per (cohort date, version) for one geo."""
    days = (1, 3, 7, 14, 30)
    g = cohorts.where(F.col("geo_country") == geo).groupBy("cohort_date", "app_version").agg(
        F.sum("cohort_size").alias("cohort_size"),
        *[F.sum(f"retained_d{n}_users").alias(f"_r{n}") for n in days])
    return g.select("cohort_date", "app_version", "cohort_size",
                    *[safe_divide(F.col(f"_r{n}"), F.col("cohort_size")).alias(f"d{n}_retention") for n in days])


def cohort_ltv_curve(ltv: DataFrame, geo: str | None = "United States") -> DataFrame:
    """R8 (recipe F): LTV at D7/D14/D30 per (cohort date, version).

    The cohort size is the sum of ``cohort_size`` on the day-0 rows, which stays right when the
    group spans several geos (the recipe's ANY_VALUE is only right with geo pinned)."""
    src = ltv if geo is None else ltv.where(F.col("geo_country") == geo)
    dsi = F.col("days_since_install")
    g = src.groupBy("cohort_date", "app_version").agg(
        F.sum(F.when(dsi == 0, F.col("cohort_size"))).alias("cohort_size"),
        *[F.sum(F.when(dsi <= n, F.col("iap_revenue")).otherwise(F.lit(0.0))).alias(f"_l{n}") for n in (7, 14, 30)])
    return g.select("cohort_date", "app_version", "cohort_size",
                    *[safe_divide(F.col(f"_l{n}"), F.col("cohort_size")).alias(f"ltv_d{n}") for n in (7, 14, 30)])


def creative_leaderboard(creative: DataFrame, as_of: _dt.date = AS_OF, days: int = 14,
                         min_plays: float = 1000, k: int = 20) -> DataFrame:
    """R9 (recipe G): ads with at least ``min_plays`` video plays, best completion rate first."""
    g = _since(creative, days, as_of).groupBy("ad_name").agg(
        F.sum("spend").alias("spend"), F.sum("video_plays").alias("plays"),
        F.sum("video_p100").alias("completed"), F.sum("installs").alias("_inst"), F.sum("clicks").alias("_clk"))
    g = g.where(F.col("plays") >= min_plays).select(
        "ad_name", "spend", "plays", "completed",
        safe_divide(F.col("completed"), F.col("plays")).alias("completion_rate"),
        safe_divide(F.col("_inst"), F.col("_clk")).alias("cvr"),
        safe_divide(F.col("spend"), F.col("_inst")).alias("ecpi"))
    return g.orderBy(F.desc_nulls_last("completion_rate"), "ad_name").limit(k)


def tutorial_completion_rate(funnel: DataFrame, as_of: _dt.date = AS_OF, days: int = 14) -> DataFrame:
    """Completed (step NULL) over started (step 1) users per tutorial."""
    step = F.col("step_num")
    g = _since(funnel, days, as_of).groupBy("tutorial_id").agg(
        F.sum(F.when(step == 1, F.col("users")).otherwise(F.lit(0))).alias("users_started"),
        F.sum(F.when(step.isNull(), F.col("users")).otherwise(F.lit(0))).alias("users_completed"))
    return g.withColumn("completion_rate", safe_divide(F.col("users_completed"), F.col("users_started")))


def tutorial_dropoff(funnel: DataFrame, tutorial_id: int = 40000, as_of: _dt.date = AS_OF,
                     days: int = 14) -> DataFrame:
    """Users per step for one tutorial."""
    f = _since(funnel.where((F.col("tutorial_id") == tutorial_id) & F.col("step_num").isNotNull()), days, as_of)
    return f.groupBy("step_num").agg(F.sum("users").alias("users")).orderBy("step_num")


def level_fail_rate(events: DataFrame) -> DataFrame:
    """Distinct failers over distinct starters per (version, level), two-level aggregate."""
    e = events.where(F.col("event_name").isin("level_started", "level_failed") & not_test_country()
                     & F.col("level_id").isNotNull())
    per_user = e.groupBy("app_version", "level_id", "user_pseudo_id").agg(
        F.max(F.when(F.col("event_name") == "level_started", 1).otherwise(0)).alias("_s"),
        F.max(F.when(F.col("event_name") == "level_failed", 1).otherwise(0)).alias("_f"))
    g = per_user.groupBy("app_version", "level_id").agg(
        F.sum("_s").cast("bigint").alias("users_started"), F.sum("_f").cast("bigint").alias("users_failed"))
    return g.withColumn("fail_rate", safe_divide(F.col("users_failed"), F.col("users_started")))


def booster_usage_by_spender(events: DataFrame) -> DataFrame:
    """Booster uses per (level, booster) split into paying and free players."""
    payers = events.where((F.col("event_name") == "iap_purchase") & (F.col("price_dollars") > 0)).select(
        F.col("user_pseudo_id").alias("_payer")).distinct()
    b = events.where((F.col("event_name") == "booster_used") & F.col("booster_id").isNotNull())
    j = b.join(payers, b.user_pseudo_id == payers._payer, "left")
    return j.groupBy("level_id", "booster_id").agg(
        F.count(F.lit(1)).alias("usage_count"), F.countDistinct("user_pseudo_id").alias("unique_users"),
        F.count_if(F.col("_payer").isNotNull()).alias("iap_usage"),
        F.count_if(F.col("_payer").isNull()).alias("free_usage"))


def coins_net_by_level(events: DataFrame) -> DataFrame:
    """Coins earned, spent, net and users per level."""
    e = events.where(F.col("event_name").isin("currency_earned", "currency_spent")
                     & (F.col("currency_type") == "Coins") & F.col("level_id").isNotNull())
    earned = F.sum(F.when(F.col("event_name") == "currency_earned", F.col("amount")).otherwise(F.lit(0.0)))
    spent = F.sum(F.when(F.col("event_name") == "currency_spent", F.col("amount")).otherwise(F.lit(0.0)))
    return e.groupBy("level_id").agg(earned.alias("total_earned"), spent.alias("total_spent"),
                                     (earned - spent).alias("net_balance"),
                                     F.countDistinct("user_pseudo_id").alias("users"))


def iap_revenue_by_product(events: DataFrame) -> DataFrame:
    """Paid purchase revenue, count and buyers by (version, level, item)."""
    e = events.where((F.col("event_name") == "iap_purchase") & (F.col("price_dollars") > 0))
    return e.groupBy("app_version", "level_id", F.col("item_name").alias("product_name")).agg(
        F.sum("price_dollars").alias("total_revenue"), F.count(F.lit(1)).alias("purchase_count"),
        F.countDistinct("user_pseudo_id").alias("unique_buyers"))


def progression_by_active_day(events: DataFrame, max_day: int = 14) -> DataFrame:
    """Players, mean and median max level per 0-based active day (0..``max_day``).
    The day rank is a window over the grouped (user, day) rows; the median is exact."""
    e = events.where(~F.col("event_name").isin("user_engagement", "screen_change") & F.col("level_id").isNotNull())
    days = e.groupBy("user_pseudo_id", "event_date").agg(F.max("level_id").alias("max_level"))
    days = days.withColumn("active_day", (F.dense_rank().over(
        Window.partitionBy("user_pseudo_id").orderBy("event_date")) - 1).cast("bigint"))
    return days.where(F.col("active_day") <= max_day).groupBy("active_day").agg(
        F.countDistinct("user_pseudo_id").alias("players"), F.avg("max_level").alias("avg_max_level"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY max_level)").cast("double").alias("median_max_level"))


def dau_and_revenue(events: DataFrame) -> DataFrame:
    """Daily active users, paying users and IAP revenue."""
    e = events.where(~F.col("event_name").isin(*NOISE3))
    paid = (F.col("event_name") == "iap_purchase") & (F.col("price_dollars") > 0)
    users = e.groupBy("event_date", "user_pseudo_id").agg(  # one row per user and day, so no distinct counts below
        F.max(F.coalesce(paid, F.lit(False))).alias("paid"),
        F.sum(F.when(F.col("event_name") == "iap_purchase", F.col("price_dollars")).otherwise(F.lit(0.0))).alias("revenue"))
    return users.groupBy("event_date").agg(
        F.count("user_pseudo_id").alias("dau"),
        F.count_if(F.col("paid") & F.col("user_pseudo_id").isNotNull()).alias("paying_users"),
        F.sum("revenue").alias("daily_revenue"))


def ltv_to_cac(ltv: DataFrame, ua: DataFrame) -> DataFrame:
    """LTV(N) (IAP revenue by day N per installed user) over CAC (eCPI), N = 7, 14, 30.

    Both sides are single-row aggregates; they are stacked and folded with one more aggregate
    instead of a join."""
    dsi = F.col("days_since_install")
    l = ltv.agg(F.sum(F.when(dsi == 0, F.col("cohort_size"))).cast("double").alias("users"),
                *[F.sum(F.when(dsi <= n, F.col("iap_revenue")).otherwise(F.lit(0.0))).alias(f"rev{n}") for n in (7, 14, 30)],
                F.lit(None).cast("double").alias("spend"), F.lit(None).cast("double").alias("installs"))
    u = ua.agg(F.lit(None).cast("double").alias("users"),
               *[F.lit(None).cast("double").alias(f"rev{n}") for n in (7, 14, 30)],
               F.sum("spend").alias("spend"), F.sum("installs").cast("double").alias("installs"))
    s = l.unionByName(u).agg(*[F.max(c).alias(c) for c in ("users", "rev7", "rev14", "rev30", "spend", "installs")])
    ecpi = safe_divide(F.col("spend"), F.col("installs"))
    out = [ecpi.alias("ecpi")]
    for n in (7, 14, 30):
        ltv_n = safe_divide(F.col(f"rev{n}"), F.col("users"))
        out += [ltv_n.alias(f"ltv_d{n}"), F.try_divide(ltv_n, F.nullif(ecpi, F.lit(0.0))).alias(f"ltv_cac_d{n}")]
    return s.select(*out)


@dataclass(frozen=True)
class Metric:
    """A ratio metric: sum(numerator) / sum(denominator) over rows of ``source``.
    Numerator and denominator are SQL expressions over one row of the source mart."""
    source: str
    num: str
    den: str

    @property
    def numerator(self) -> Column:
        return F.expr(self.num)

    @property
    def denominator(self) -> Column:
        return F.expr(self.den)


METRICS: dict[str, Metric] = {
    "roas": Metric("ua_performance_daily", "cohort_revenue", "spend"),
    "roas_ad": Metric("ua_performance_daily", "ad_revenue", "spend"),
    "roi": Metric("ua_performance_daily", "all_revenue - coalesce(spend, 0)", "spend"),
    "ecpi": Metric("ua_performance_daily", "spend", "installs"),
    "ctr": Metric("ua_performance_daily", "clicks", "impressions"),
    "cvr": Metric("ua_performance_daily", "installs", "clicks"),
    "ecpc": Metric("ua_performance_daily", "spend", "clicks"),
    "ecpm": Metric("ua_performance_daily", "1000 * spend", "impressions"),
    "arpdau_ua": Metric("ua_performance_daily", "revenue", "daus"),
    "iap_share": Metric("ua_performance_daily", "revenue", "all_revenue"),
    "ad_share": Metric("ua_performance_daily", "ad_revenue", "all_revenue"),
    "arpdau": Metric("engagement_daily", "total_revenue", "dau"),
    "arppu": Metric("engagement_daily", "iap_revenue", "payers"),
    "arpdau_iap": Metric("iap_arpdau_daily", "iap_revenue", "dau"),
    "impr_to_click_rate": Metric("ua_funnel_daily", "clicks", "impressions"),
    "click_to_install_rate": Metric("ua_funnel_daily", "installs", "clicks"),
    "install_to_event_rate": Metric("ua_funnel_daily", "events", "installs"),
    "install_to_purchase_rate": Metric("ua_funnel_daily", "revenue_events", "installs"),
    "install_arpu_d0": Metric("ua_funnel_daily", "cohort_revenue", "installs"),
    "ecpi_meta": Metric("creative_performance_daily", "spend", "installs"),
    "cvr_meta": Metric("creative_performance_daily", "installs", "clicks"),
    "roas_meta": Metric("creative_performance_daily", "purchase_value", "spend"),
    "video_completion_rate": Metric("creative_performance_daily", "video_p100", "video_plays"),
    **{f"d{n}_retention": Metric("engagement_daily", f"d{n}_retention * dau", "dau") for n in (1, 7, 30)},
    **{f"retained_d{n}": Metric("retention_cohorts", f"retained_d{n}_users", "cohort_size") for n in (1, 3, 7, 14, 30)},
    # a cohort has one row a day and its size on each: the size counts once, on day 0
    **{f"ltv_d{n}": Metric("cohort_ltv_daily", f"CASE WHEN days_since_install <= {n} THEN iap_revenue END",
                           "CASE WHEN days_since_install = 0 THEN cohort_size END") for n in (0, 7, 14, 30)},
    # completion rows have no step
    "tutorial_completion": Metric("tutorial_funnel_daily", "CASE WHEN step_num IS NULL THEN users END",
                                  "CASE WHEN step_num = 1 THEN users END"),
}


def metric_rollup(df: DataFrame, metrics: list[str], dims: list[str]) -> DataFrame:
    """Any ratio metric by any dimension list, as sum(numerator) / sum(denominator).

    All metrics must come from the same source mart (``df``). One aggregate, no AVG of a rate.
    ``roi``'s numerator is ``all_revenue - coalesce(spend, 0)`` per row, i.e. sum(all_revenue) over all
    rows minus sum(spend), as in the mart's own definition."""
    sources = {METRICS[m].source for m in metrics}
    if len(sources) != 1:
        raise ValueError(f"metrics come from different marts: {sorted(sources)}")
    aggs = []
    for m in metrics:
        aggs += [F.sum(METRICS[m].numerator).alias(f"_{m}_n"), F.sum(METRICS[m].denominator).alias(f"_{m}_d")]
    g = df.groupBy(*dims).agg(*aggs)
    return g.select(*dims, *[safe_divide(F.col(f"_{m}_n"), F.col(f"_{m}_d")).alias(m) for m in metrics])
