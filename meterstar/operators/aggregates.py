"""Reporting tables at client, model, region and feature grain.

Groups with a NULL key are left out, an empty sum is 0, and means skip NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.ranking import rank
from meterstar.session import materialise


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose group keys are all present."""
    return df.na.drop(subset=list(keys))


def _volume() -> list:
    return [
        C.total("CostUSD").alias("TotalCost"),
        C.total_long("TotalTokens").alias("TotalTokens"),
        F.count("UsageID").alias("RequestCount"),
        C.mean("LatencyMs").alias("AvgLatency"),
        C.share_pct("SuccessFlag").alias("SuccessRate"),
    ]


def client_monthly(master: DataFrame) -> DataFrame:
    """Volume, service, distinct models and premium share per client and month."""
    keys = ["ClientKey", "ClientName", "Month"]
    return keyed(master, *keys).groupBy(*keys).agg(
        *_volume(),
        C.mean("SatisfactionScore").alias("AvgSatisfaction"),
        F.count_distinct("ModelKey").alias("UniqueModelsUsed"),
        C.share_pct("IsPremium").alias("PremiumFeatureUsagePct"),
    )


def model_performance(master: DataFrame) -> DataFrame:
    """Service and cost per model, ranked by cost (largest first) and latency (smallest first)."""
    keys = ["ModelKey", "ModelName", "Provider"]
    models = materialise(keyed(master, *keys).groupBy(*keys).agg(
        C.mean("LatencyMs").alias("AvgLatency"),
        C.share_pct("SuccessFlag").alias("SuccessRate"),
        C.mean("SatisfactionScore").alias("AvgSatisfaction"),
        C.total("CostUSD").alias("TotalCost"),
        F.count("UsageID").alias("TotalRequests"),
        C.mean("TokenEfficiencyRatio").alias("AvgTokenEfficiency"),
    ))
    return ranked_models(models)


def ranked_models(models: DataFrame) -> DataFrame:
    """Models with their rank by cost and by latency."""
    ranked = rank(models, "TotalCost", "CostRank", descending=True)
    return rank(ranked, "AvgLatency", "LatencyRank")


def region_monthly(master: DataFrame) -> DataFrame:
    """Volume and service per region and month."""
    keys = ["RegionKey", "RegionName", "Month"]
    return keyed(master, *keys).groupBy(*keys).agg(*_volume())


def feature_adoption(master: DataFrame) -> DataFrame:
    """Use of each feature and the share of all clients that used it.

    The share counts every client of the fact, whatever the feature's class.
    """
    keys = ["FeatureKey", "FeatureName", "IsPremium"]
    clients = master.agg(F.count_distinct("ClientKey"))
    return keyed(master, *keys).groupBy(*keys).agg(
        F.count("UsageID").alias("UsageCount"),
        F.count_distinct("ClientKey").alias("_clients"),
        C.mean("SatisfactionScore").alias("AvgSatisfactionByFeature"),
    ).withColumn("PremiumAdoptionRate", C.ratio("_clients", clients.scalar()) * 100.0).drop("_clients")


def build_aggregates(master: DataFrame) -> dict[str, DataFrame]:
    """The four reporting tables by name."""
    return {
        "agg_client_monthly": client_monthly(master),
        "agg_model_performance": model_performance(master),
        "agg_region_monthly": region_monthly(master),
        "agg_feature_adoption": feature_adoption(master),
    }
