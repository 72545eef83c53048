"""Ten analyses over the denormalised usage rows.

Each works on pre-aggregated rows: windows run over days, months, models or
regions, never over raw requests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.ranking import Tiles, ntile, rank
from meterstar.session import materialise


def rolling_model_cost(usage: DataFrame, days: int = 7) -> DataFrame:
    """Daily cost per model, the previous observed day, and the average over calendar days."""
    daily = usage.groupBy("ModelKey", "ModelName", "Date").agg(C.total("CostUSD").alias("DailyCostUSD"))
    # Days as numbers give both windows one order, so one sort serves them.
    daily = daily.withColumn("_day", F.unix_date("Date"))
    by_day = W.partitionBy("ModelKey").orderBy("_day")
    return daily.select(
        "ModelKey", "ModelName", "Date", "DailyCostUSD",
        F.lag("DailyCostUSD").over(by_day).alias("PriorDayCostUSD"),
        F.avg("DailyCostUSD").over(by_day.rangeBetween(-(days - 1), 0)).alias("Rolling7DayAvgCostUSD"),
    )


def model_cost_efficiency(usage: DataFrame) -> DataFrame:
    """Cost per 1000 tokens per model, ranked within its provider; a model without tokens ranks last."""
    cost = materialise(usage.groupBy("ModelKey", "ModelName", "Provider").agg(
        (C.ratio(F.sum("CostUSD"), F.sum("TotalTokens")) * 1000.0).alias("CostPer1000Tokens")
    ))
    return rank(cost, "CostPer1000Tokens", "ProviderCostRank", by=["Provider"], rank_nulls=True)


def client_rfm(usage: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value per client, each in quartiles, and the segment code."""
    clients = materialise(
        usage.groupBy("ClientKey", "ClientName").agg(
            F.max("Date").alias("_last"),
            F.count(F.lit(1)).alias("Frequency"),
            C.total("CostUSD").alias("MonetaryUSD"),
        )
    )
    last_day = clients.agg(F.max("_last").alias("d"))
    clients = clients.select(
        "ClientKey", "ClientName",
        F.datediff(last_day.scalar(), "_last").cast("bigint").alias("RecencyDays"),
        "Frequency", "MonetaryUSD",
    )
    scored = ntile(clients, "ClientKey", [
        Tiles("RecencyScore", "RecencyDays", descending=True),
        Tiles("FrequencyScore", "Frequency"),
        Tiles("MonetaryScore", "MonetaryUSD"),
    ])
    return scored.withColumn(
        "RFMSegment",
        F.concat(*[F.col(c).cast("string") for c in ("RecencyScore", "FrequencyScore", "MonetaryScore")]),
    )


def feature_adoption_funnel(usage: DataFrame) -> DataFrame:
    """Share of all clients that used each feature."""
    pairs = usage.select("FeatureKey", "FeatureName", "ClientKey").distinct()
    clients = pairs.agg(F.count_distinct("ClientKey").alias("n"))
    return pairs.groupBy("FeatureKey", "FeatureName").agg(F.count("ClientKey").alias("AdoptingClients")).withColumn(
        "AdoptionPct", C.ratio(F.col("AdoptingClients") * 100.0, clients.scalar())
    )


def region_growth(usage: DataFrame) -> DataFrame:
    """Cost and requests per region and month against the previous observed month."""
    monthly = usage.groupBy("RegionKey", "RegionName", "Month").agg(
        C.total("CostUSD").alias("TotalCostUSD"), F.count(F.lit(1)).alias("RequestCount")
    )
    by_month = W.partitionBy("RegionKey").orderBy("Month")
    prior = monthly.withColumns({
        "PriorMonthCostUSD": F.lag("TotalCostUSD").over(by_month),
        "PriorMonthRequestCount": F.lag("RequestCount").over(by_month),
    })
    cost_change = F.col("TotalCostUSD") - F.col("PriorMonthCostUSD")
    request_change = F.col("RequestCount") - F.col("PriorMonthRequestCount")
    return prior.withColumns({
        "CostChangeUSD": cost_change,
        "CostGrowthPct": C.ratio(cost_change * 100.0, "PriorMonthCostUSD"),
        "RequestChange": request_change,
        "RequestGrowthPct": C.ratio(request_change * 100.0, "PriorMonthRequestCount"),
    })


def upsell_candidates(usage: DataFrame, above_pct: float = 80, except_tier: str = "Enterprise", parts: int | None = None) -> DataFrame:
    """Client-months above a share of their quota, outside one tier.

    Works on client-month-tier totals: the month's tokens are their sum, so no
    value is joined back to the requests. One client-month has few tiers.
    ``parts`` (see ``session.task_parts``) is the number of tasks for the windows, for many client-months.
    """
    totals = usage.groupBy("ClientKey", "ClientName", "Month", "TierName", "MonthlyQuotaTokens").agg(
        F.sum("TotalTokens").alias("_tokens")
    )
    totals = totals.repartition(parts, "ClientKey", "Month") if parts else totals
    month = W.partitionBy("ClientKey", "Month")
    used = totals.withColumn("MonthlyTokensUsed", F.sum("_tokens").over(month).cast("bigint"))
    pct = C.ratio("MonthlyTokensUsed", "MonthlyQuotaTokens") * 100.0
    return (
        used.withColumn("QuotaUtilizationPct", pct)
        .where((F.col("QuotaUtilizationPct") > above_pct) & (F.col("TierName") != except_tier))
        .select("ClientKey", "ClientName", "Month", "TierName", "QuotaUtilizationPct", "MonthlyTokensUsed",
                F.lit("Upsell opportunity").alias("Opportunity"))
        .distinct()
    )


def model_substitution(usage: DataFrame) -> DataFrame:
    """Savings if each client's main model were replaced by the cheapest observed per feature.

    Repricing is linear in the tokens, so one pass to client-model-feature
    totals is enough; they are written once and read three times, and the
    requests are never joined to anything.
    """
    model = ["ModelKey", "ModelName", "CostPer1kInput", "CostPer1kOutput"]
    totals = materialise(usage.groupBy("ClientKey", "FeatureKey", *model).agg(
        F.count(F.lit(1)).alias("_requests"),
        F.sum("CostUSD").alias("_cost"),
        F.sum("TokensInput").alias("_in"),
        F.sum("TokensOutput").alias("_out"),
    ))
    primary = (
        totals.groupBy("ClientKey", "ModelKey", "ModelName").agg(F.sum("_requests").alias("_n"))
        .groupBy("ClientKey")
        .agg(F.min(F.struct((-F.col("_n")).alias("order"), "ModelKey", "ModelName")).alias("p"))
        .select("ClientKey", F.col("p.ModelKey").alias("ModelKey"), F.col("p.ModelName").alias("PrimaryModelName"))
    )
    cheapest = (
        totals.groupBy("FeatureKey")
        .agg(F.min(F.struct((F.col("CostPer1kInput") + F.col("CostPer1kOutput")).alias("rate"), *model)).alias("c"))
        .select("FeatureKey", F.col("c.ModelName").alias("CheapestModelName"),
                F.col("c.CostPer1kInput").alias("_rate_in"), F.col("c.CostPer1kOutput").alias("_rate_out"))
    )
    repriced = F.col("_in") * F.col("_rate_in") / 1000 + F.col("_out") * F.col("_rate_out") / 1000
    main = totals.select("ClientKey", "FeatureKey", "ModelKey", "_cost", "_in", "_out")
    return (
        main.join(primary, ["ClientKey", "ModelKey"])
        .join(cheapest, "FeatureKey")
        .groupBy("ClientKey", "PrimaryModelName", "CheapestModelName")
        .agg(C.total("_cost").alias("CurrentCostUSD"), F.sum(repriced).alias("CheapestEquivalentCostUSD"))
        .withColumn("EstimatedSavingsUSD", F.col("CurrentCostUSD") - F.col("CheapestEquivalentCostUSD"))
        .where("EstimatedSavingsUSD > 0")
    )


def cost_satisfaction_correlation(usage: DataFrame) -> DataFrame:
    """Pearson correlation of cost and satisfaction over rated requests; NULL without variance."""
    x, y = C.as_double("CostUSD"), C.as_double("SatisfactionScore")
    return usage.where("SatisfactionScore IS NOT NULL").agg(
        # Centred second moments: stable where raw sums of squares cancel.
        C.ratio(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y))).alias("CostSatisfactionCorrelation")
    )


def cost_anomalies(usage: DataFrame, clients: DataFrame, models: DataFrame, deviations: float = 2, limit: int = 20) -> DataFrame:
    """Requests costing more than their model's mean plus some deviations, largest excess first.

    ``usage`` needs no names: the dimensions only filter it by key, and the rows that are left
    after the limit get their names. The per-model figures are written first, so that their exact size decides
    between a broadcast and a skew-splitting join.
    """
    cost = C.as_double("CostUSD")
    known = usage.select("UsageID", "Date", "ClientKey", "ModelKey", cost.alias("CostUSD"))
    known = known.join(clients, "ClientKey", "left_semi").join(models, "ModelKey", "left_semi")
    figures = materialise(
        known.groupBy("ModelKey").agg(
            F.avg("CostUSD").alias("ModelAvgCostUSD"), F.stddev_pop("CostUSD").alias("ModelStdDevCostUSD")
        )
    )
    threshold = F.col("ModelAvgCostUSD") + deviations * F.col("ModelStdDevCostUSD")
    order = [F.desc("ExcessCostUSD"), F.asc("UsageID")]
    found = (
        known.join(figures, "ModelKey")
        .withColumn("AnomalyThresholdUSD", threshold)
        .where(F.col("CostUSD") > F.col("AnomalyThresholdUSD"))
        .withColumn("ExcessCostUSD", F.col("CostUSD") - F.col("AnomalyThresholdUSD"))
        .orderBy(*order)
        .limit(limit)
    )
    named = materialise(found).join(clients.select("ClientKey", "ClientName"), "ClientKey").join(
        models.select("ModelKey", "ModelName"), "ModelKey")
    return named.select(
        "UsageID", "Date", "ClientKey", "ClientName", "ModelName", "CostUSD", "ModelAvgCostUSD", "ModelStdDevCostUSD",
        "AnomalyThresholdUSD", "ExcessCostUSD",
    ).orderBy(*order)


def cohort_retention(usage: DataFrame) -> DataFrame:
    """Share of each onboarding month's clients active in each later month."""
    active = usage.select(
        "ClientKey", C.month_label("OnboardingDate").alias("CohortMonth"), F.col("Month").alias("ActivityMonth")
    ).distinct()
    sizes = active.groupBy("CohortMonth").agg(F.count_distinct("ClientKey").alias("CohortSize"))
    months = (
        active.where("ActivityMonth >= CohortMonth")
        .groupBy("CohortMonth", "ActivityMonth")
        .agg(F.count("ClientKey").alias("ActiveClients"))
    )
    return months.join(sizes, "CohortMonth").select(
        "CohortMonth", "ActivityMonth", "CohortSize", "ActiveClients",
        C.ratio(F.col("ActiveClients") * 100.0, "CohortSize").alias("RetentionPct"),
    )
