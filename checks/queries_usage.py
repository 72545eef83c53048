"""Registered: enrichment, reporting tables, filters and measures."""

from pyspark.sql import functions as F

from checks.registry import item_parts, register, requested, rounded, shipped, with_efficiency
from meterstar.functions import columns as C
from meterstar.functions.holidays import is_us_holiday
from meterstar.operators import aggregates, enrich, kpis, ranking
from meterstar.session import materialise
from meterstar.sources import samples

DERIVED = [
    "UsageID", "TokenEfficiencyRatio", "CostPerSuccessfulRequest", "TheoreticalCostUSD", "CostVariance",
    "IsOverBudget", "HourOfDay", "PeakHour", "ResponseSpeedTier", "SatisfactionBucket", "DaysSinceOnboarding",
    "IsFirstWeekClient", "ClientAgeCohort", "Month",
]


@register("s3_fact_view")
def _(spark, sf_dir):
    view = enrich.fact_view(samples.requests(spark, sf_dir))
    return rounded(view.select(
        "UsageID", "Date", "Month", "ClientName", "ModelName", "Provider", "FeatureName", "RegionName", "TierName",
        "MonthlyQuotaTokens", "MonthlyTokensUsed", "QuotaUtilizationPct",
    ))


@register("e0_star_join")
def _(spark, sf_dir):
    tables = samples.requests(spark, sf_dir)
    dates = tables["date"].drop("Month")
    joined = enrich.star_join(tables.replace(date=dates))
    return joined.select("UsageID", "Date", "Quarter", "IsWeekend", "ClientName", "ModelName", "FeatureName",
                         "IsPremium", "RegionName", "TierName")


@register("e1_to_e13_derived")
def _(spark, sf_dir):
    return rounded(enrich.enrich(samples.requests(spark, sf_dir), validate=False).select(*DERIVED), 8)


@register("e14_running_tokens")
def _(spark, sf_dir):
    usage = requested(spark, sf_dir)
    return enrich.running_monthly_tokens(usage).select("UsageID", "ClientKey", "Month", "MonthlyTokensUsed")


@register("e14_running_tokens_by_months")
def _(spark, sf_dir):
    """Over seven years; lines that share id and time are one step."""
    steps = shipped(spark, sf_dir).groupBy("UsageID", "ClientKey", "Month", "Date", "TimeKey").agg(
        F.sum("TotalTokens").alias("TotalTokens"))
    return enrich.running_monthly_tokens(steps).select("UsageID", "ClientKey", "Month", "Date", "TimeKey", "MonthlyTokensUsed")


@register("e14b_month_tokens")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir).select("UsageID", "ClientKey", "Month", "TotalTokens")
    return enrich.month_tokens(usage, item_parts(spark, sf_dir)).select("UsageID", "ClientKey", "Month", "TotalTokens", "MonthlyTokensUsed")


@register("e15_e17_effective_cost")
def _(spark, sf_dir):
    master = enrich.enrich(samples.requests(spark, sf_dir), validate=False)
    return rounded(master.select("UsageID", "QuotaUtilizationPct", "IsOverQuota", "EffectiveCostWithOverage"), 7)


@register("e15_zero_quota")
def _(spark, sf_dir):
    """One tier without quota, whose use counts as over."""
    tables = samples.requests(spark, sf_dir)
    quota = F.when(F.col("TierName") == "Free", 0).otherwise(F.col("MonthlyQuotaTokens")).cast("bigint")
    tables = tables.replace(subscription=tables["subscription"].withColumn("MonthlyQuotaTokens", quota))
    master = enrich.enrich(tables, validate=False, zero_quota_is_over=True)
    infinite = F.col("QuotaUtilizationPct") == float("inf")
    return rounded(master.select("UsageID", infinite.alias("IsInfinite"), "IsOverQuota", "EffectiveCostWithOverage"), 7)


@register("p1_cascade_filter")
def _(spark, sf_dir):
    usage = requested(spark, sf_dir, "client", "model", "region")
    kept = kpis.cascade_filter(usage, {"RegionName": ["ASIA", "EUROPE"], "Provider": ["Brand#2", "Brand#17", "Brand#5"]})
    return kept.select("UsageID", "RegionName", "Provider", "ModelName", "ClientName")


@register("p1_facet_values")
def _(spark, sf_dir):
    usage = requested(spark, sf_dir, "region", "model")
    return kpis.facet_values(kpis.cascade_filter(usage, {"RegionName": ["ASIA"]}), "Provider")


@register("a1_client_month")
def _(spark, sf_dir):
    return rounded(aggregates.client_monthly(shipped(spark, sf_dir, "client", "feature")))


@register("a2_model_performance")
def _(spark, sf_dir):
    return rounded(aggregates.model_performance(with_efficiency(shipped(spark, sf_dir, "model"))))


@register("a3_region_month")
def _(spark, sf_dir):
    return rounded(aggregates.region_monthly(shipped(spark, sf_dir, "region")))


@register("a4_feature_adoption")
def _(spark, sf_dir):
    return rounded(aggregates.feature_adoption(shipped(spark, sf_dir, "feature")))


@register("a5_overview")
def _(spark, sf_dir):
    usage = requested(spark, sf_dir).withColumn("IsAnomaly", F.col("LatencyMs") > 2000)
    return rounded(kpis.overview(usage))


@register("a6_monthly_trend")
def _(spark, sf_dir):
    return rounded(kpis.monthly_trend(shipped(spark, sf_dir)))


@register("a7_model_costs")
def _(spark, sf_dir):
    return rounded(kpis.model_costs(with_efficiency(shipped(spark, sf_dir, "model"))))


@register("a8_provider_costs")
def _(spark, sf_dir):
    return rounded(kpis.provider_costs(shipped(spark, sf_dir, "model")))


@register("a9_feature_use")
def _(spark, sf_dir):
    return rounded(kpis.feature_use(shipped(spark, sf_dir, "feature")))


def formula_scores(usage):
    """A score per client that SQL can repeat: its share of failed requests; some have none."""
    return usage.groupBy("ClientKey").agg(
        F.when(F.col("ClientKey") % 10 != 3, F.round((1.0 - F.avg("SuccessFlag")) * 150, 2)).alias("ChurnRiskScore")
    )


@register("a10_client_health")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir, "client", "feature")
    health = kpis.client_health(aggregates.client_monthly(usage), formula_scores(usage))
    return rounded(health)


@register("a11_risk_bands")
def _(spark, sf_dir):
    return kpis.risk_distribution(formula_scores(shipped(spark, sf_dir)))


@register("a12_quota_latest")
def _(spark, sf_dir):
    return rounded(kpis.quota_by_client(enrich.enrich(samples.requests(spark, sf_dir), validate=False)))


@register("a14_histogram")
def _(spark, sf_dir):
    return rounded(kpis.histogram(requested(spark, sf_dir), "LatencyMs"))


@register("a19_flag_patterns")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir)
    flags = usage.select(
        (F.col("CostUSD") > 60000).cast("int").alias("HighCost"),
        (F.col("TotalTokens") > 200).cast("int").alias("ManyTokens"),
        (F.col("LatencyMs") > 1200).cast("int").alias("Slow"),
    )
    return kpis.flag_patterns(flags, ["HighCost", "ManyTokens", "Slow"])


@register("a20_client_feature_counts")
def _(spark, sf_dir):
    return kpis.client_feature_counts(shipped(spark, sf_dir, "client", "feature"))


@register("a20_heatmap")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir, "client", "feature")
    return kpis.client_feature_heatmap(usage, [name for _, name, _ in samples.PRIORITIES])


@register("o3_top_rows")
def _(spark, sf_dir):
    return rounded(kpis.top_rows(kpis.provider_costs(shipped(spark, sf_dir, "model")), "TotalCost", "Provider"))


@register("b_measures")
def _(spark, sf_dir):
    columns = ["SuccessFlag", "LatencyMs", "CostUSD", "TotalTokens"]
    stored = materialise(shipped(spark, sf_dir).select(*columns))  # the measures read it several times
    return rounded(kpis.business_measures(stored, high_latency_ms=1200.0))


@register("v3_scorecard")
def _(spark, sf_dir):
    models = aggregates.model_performance(with_efficiency(shipped(spark, sf_dir, "model")))
    return rounded(kpis.model_scorecard(models, key="ModelKey"))


@register("v5_scatter_points")
def _(spark, sf_dir):
    return rounded(kpis.scatter_points(requested(spark, sf_dir, "model"), "LatencyMs", "SatisfactionScore", "ModelName"))


@register("v5_cost_scatter_points")
def _(spark, sf_dir):
    usage = requested(spark, sf_dir, "model").withColumn("CostUSD", F.col("CostUSD").cast("double"))
    return rounded(kpis.scatter_points(usage, "CostUSD", "TotalTokens", "LatencyMs", "ModelName"))


@register("r1_row_index")
def _(spark, sf_dir):
    orders = samples.fact_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.row_index(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@register("r1_global_rank")
def _(spark, sf_dir):
    orders = samples.fact_table(spark, sf_dir, "orders").select("o_orderkey", F.round("o_totalprice", -3).alias("price"))
    return ranking.rank(orders, "price", "PriceRank", descending=True)


@register("r2_quantiles")
def _(spark, sf_dir):
    item = samples.fact_table(spark, sf_dir, "lineitem")
    found = ranking.quantiles(item, {"l_extendedprice": (0.25, 0.5, 0.75, 0.98), "l_quantity": (0.25, 0.5, 0.75)})
    rows = [(c, p, v) for c, values in found.items() for p, v in values.items()]
    return rounded(spark.createDataFrame(rows, "measure string, p double, quantile double"))


@register("r3_ntile")
def _(spark, sf_dir):
    orders = samples.fact_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.ntile(orders, "o_orderkey", [
        ranking.Tiles("by_price", "o_totalprice"),
        ranking.Tiles("by_client", "o_custkey", buckets=7, descending=True),
    ])


@register("f8_holidays")
def _(spark, sf_dir):
    days = samples.calendar(spark, sf_dir)
    return days.select("Date", is_us_holiday("Date").alias("IsHoliday"), C.is_weekend("Date").alias("IsWeekend"))
