"""Client features for disengagement scoring, and the operational proxy label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.session import task_parts

# The model's inputs.
CHURN_FEATURES = (
    "DaysSinceLastRequest", "AvgMonthlyCostTrend", "SatisfactionTrend", "SuccessRateLast30Days",
    "SuccessRateOverall", "QuotaUtilizationPct", "PremiumFeatureUsagePct",
)
# The proxy calls a client disengaged beyond this many days and below this utilisation.
INACTIVE_DAYS, LOW_UTILISATION_PCT = 45, 20


def slope(value: Column | str, period: Column | str) -> Column:
    """Least-squares slope; 0 with fewer than two usable points or a single period."""
    return F.coalesce(F.regr_slope(C.col(value), C.col(period)), F.lit(0.0))


def churn_features(master: DataFrame, recent_days: int = 30) -> DataFrame:
    """One row per client: recency, monthly trends, success rates, quota use, premium share.

    One pass combines the requests to client-months and a second those to
    clients. There are nearly as many client-months as requests, so both passes are dealt out
    by the number of requests. Recent means counted back from the newest date of the whole data,
    the first and last day included.
    """
    whole = master.agg(F.max("Date").alias("end"), F.count(F.lit(1)).alias("rows")).first()
    end, parts = F.lit(whole["end"]).cast("date"), task_parts(master.sparkSession, whole["rows"])
    recent = F.col("Date") >= F.date_sub(end, recent_days)
    placed = master.na.drop(subset=["ClientKey"]).withColumn("_month", C.month_number("Date")).repartition(parts, "ClientKey", "_month")
    monthly = placed.groupBy("ClientKey", "_month").agg(
        F.max("Date").alias("_last"),
        C.total("CostUSD").alias("_cost"),
        C.mean("SatisfactionScore").alias("_satisfaction"),
        F.sum(F.when(recent, F.col("SuccessFlag"))).alias("_recent_ok"),
        F.count(F.when(recent, F.col("SuccessFlag"))).alias("_recent_n"),
        F.sum("SuccessFlag").alias("_ok"),
        F.count("SuccessFlag").alias("_n"),
        F.max("QuotaUtilizationPct").alias("_quota"),
        F.sum(F.col("IsPremium").cast("int")).alias("_premium"),
        F.count("IsPremium").alias("_premium_n"),
    )
    return monthly.repartition(parts, "ClientKey").groupBy("ClientKey").agg(
        F.datediff(end, F.max("_last")).alias("DaysSinceLastRequest"),
        slope("_cost", "_month").alias("AvgMonthlyCostTrend"),
        slope("_satisfaction", "_month").alias("SatisfactionTrend"),
        C.ratio(F.sum("_recent_ok"), F.sum("_recent_n")).alias("SuccessRateLast30Days"),
        C.ratio(F.sum("_ok"), F.sum("_n")).alias("SuccessRateOverall"),
        F.max("_quota").alias("QuotaUtilizationPct"),
        (C.ratio(F.sum("_premium"), F.sum("_premium_n")) * 100.0).alias("PremiumFeatureUsagePct"),
    )


def proxy_label() -> Column:
    """1 for a client long inactive and little used; an operational proxy, not confirmed churn."""
    return (
        (F.col("DaysSinceLastRequest") > INACTIVE_DAYS) & (F.col("QuotaUtilizationPct") < LOW_UTILISATION_PCT)
    ).cast("int")
