"""Dashboard and business measures, filters, top lists and chart inputs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.aggregates import keyed
from meterstar.operators.ranking import quantiles
from meterstar.sources.star import require_columns

FILTER_COLUMNS = ("RegionName", "Provider", "ModelName", "ClientName")


# --- filters ---------------------------------------------------------------

def facet_values(df: DataFrame, column: str) -> DataFrame:
    """The values a filter on ``column`` can offer, sorted."""
    return df.select(column).na.drop().distinct().orderBy(column)


def cascade_filter(df: DataFrame, selected: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows whose filter columns hold selected values.

    A column without a selection keeps every value but NULL, as a filter that
    offers the present values and selects all of them does.
    """
    for column in FILTER_COLUMNS:
        if column in df.columns:
            keep = F.col(column).isin(list(selected[column])) if column in selected else F.col(column).isNotNull()
            df = df.where(keep)
    return df


def only_flagged(df: DataFrame, flag: str, enabled: bool = True) -> DataFrame:
    """Rows with the flag set, or all rows if the toggle is off."""
    return df.where(F.coalesce(F.col(flag), F.lit(False))) if enabled else df


def scatter_points(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with all columns present."""
    return df.select(*columns).na.drop(subset=list(columns))


# --- headline figures and trends ---------------------------------------------

def overview(usage: DataFrame, anomaly_flag: str = "IsAnomaly") -> DataFrame:
    """Headline figures of the filtered usage; zeros on empty input, but no satisfaction."""
    def pct(c: Column) -> Column:
        return F.coalesce(C.share_pct(c), F.lit(0.0))

    return usage.agg(
        F.count(F.lit(1)).alias("requests"),
        C.total("CostUSD").alias("cost"),
        C.total_long("TotalTokens").alias("tokens"),
        pct(F.col("SuccessFlag")).alias("success_rate"),
        C.mean("SatisfactionScore").alias("satisfaction"),
        pct(F.col("SatisfactionScore").isNotNull()).alias("satisfaction_coverage"),
        pct(F.col(anomaly_flag)).alias("anomaly_rate"),
        C.mean("LatencyMs").alias("avg_latency"),
    )


def monthly_trend(usage: DataFrame) -> DataFrame:
    """Cost, tokens, requests and success rate per month of the request date."""
    monthly = usage.withColumn("Month", C.month_label("Date"))
    return keyed(monthly, "Month").groupBy("Month").agg(
        C.total("CostUSD").alias("CostUSD"),
        C.total_long("TotalTokens").alias("TotalTokens"),
        F.count("UsageID").alias("RequestCount"),
        C.share_pct("SuccessFlag").alias("SuccessRate"),
    )


def model_costs(usage: DataFrame) -> DataFrame:
    """Cost, requests and service per model name and provider."""
    keys = ["ModelName", "Provider"]
    return keyed(usage, *keys).groupBy(*keys).agg(
        C.total("CostUSD").alias("TotalCost"),
        F.count("UsageID").alias("Requests"),
        C.mean("LatencyMs").alias("AvgLatency"),
        C.mean("TokenEfficiencyRatio").alias("AvgTokenEfficiency"),
        C.mean("SatisfactionScore").alias("AvgSatisfaction"),
    )


def provider_costs(usage: DataFrame) -> DataFrame:
    """Cost and requests per provider."""
    return keyed(usage, "Provider").groupBy("Provider").agg(
        C.total("CostUSD").alias("TotalCost"), F.count("UsageID").alias("Requests")
    )


def feature_use(usage: DataFrame) -> DataFrame:
    """Requests, premium share and satisfaction per feature name."""
    return keyed(usage, "FeatureName").groupBy("FeatureName").agg(
        F.count("UsageID").alias("Requests"),
        C.share_pct("IsPremium").alias("PremiumRate"),
        C.mean("SatisfactionScore").alias("AvgSatisfaction"),
    )


# --- client health -------------------------------------------------------------

def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the last in ``order``; add a unique column so that ties are decided.

    An aggregate over a struct: combined before the shuffle, so a hot key costs
    no more than any other.
    """
    keep = [c for c in (columns or df.columns) if c not in keys]
    newest = F.max_by(F.struct(*keep), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, *[F.col(f"_row.`{c}`") for c in keep])


def client_health(clients: DataFrame, churn: DataFrame) -> DataFrame:
    """Each client's latest month with its churn score, if it has one."""
    latest = latest_per_key(keyed(clients, "ClientKey"), ["ClientKey"], ["Month", "ClientName"])
    return latest.join(churn, "ClientKey", "left")


def risk_distribution(health: DataFrame) -> DataFrame:
    """Clients per risk band; empty bands stay, clients without a score do not count."""
    counts = (
        health.withColumn("RiskBand", C.risk_band("ChurnRiskScore"))
        .where("RiskBand IS NOT NULL").groupBy("RiskBand").agg(F.count(F.lit(1)).alias("n"))
    )
    bands = health.sparkSession.createDataFrame(list(enumerate(C.RISK_BANDS)), "BandOrder int, RiskBand string")
    return bands.join(counts, "RiskBand", "left").select(
        "BandOrder", "RiskBand", F.coalesce("n", F.lit(0)).cast("bigint").alias("Clients")
    )


def quota_by_client(usage: DataFrame) -> DataFrame:
    """Each client's latest quota figures. Sort for display with ``by_value``."""
    keys = ["ClientKey", "ClientName"]
    return latest_per_key(
        keyed(usage, *keys), keys, ["Date", "TimeKey", "UsageID"], ["QuotaUtilizationPct", "IsOverQuota"]
    )


# --- orders and top lists --------------------------------------------------------

def by_value(df: DataFrame, value: str, tie: str, descending: bool = True) -> DataFrame:
    """Sorted for display, ties decided by ``tie``."""
    return df.orderBy(F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last(), tie)


def top_rows(df: DataFrame, value: str, label: str, limit: int = 10) -> DataFrame:
    """The rows with the largest values, shown smallest first."""
    top = df.where(F.col(value).isNotNull()).orderBy(F.desc(value), label).limit(limit)
    return top.select(label, value).orderBy(F.asc(value), F.desc(label))


def positive_counts(summary: DataFrame) -> DataFrame:
    """Rows of an anomaly summary that count something, smallest first."""
    return summary.where("Count > 0").select("Pattern", "Count").orderBy("Count", "Pattern")


# --- chart inputs ------------------------------------------------------------------

def nice_step(low: float, high: float, max_bins: int = 10) -> tuple[float, float, int]:
    """Start, width and number of bins: the least 1, 2 or 5 times a power of ten that needs at most ``max_bins`` widths."""
    span = high - low
    if span <= 0:
        return low, 1.0, 1
    power = math.floor(math.log10(span / max_bins))
    widths = (m * 10.0**k if k >= 0 else m / 10.0**-k for k in (power - 1, power, power + 1, power + 2) for m in (1, 2, 5))
    step = next(w for w in widths if span / w <= max_bins)
    start = math.floor(low / step) * step
    return start, step, max(math.ceil((high - start) / step - 1e-12), 1)


def histogram(df: DataFrame, column: str, max_bins: int = 10) -> DataFrame:
    """Counts per bin of a numeric column; the top edge belongs to the last bin.

    Two passes: the ends (one row), then the counts with map-side combine.
    """
    value = F.col(column).cast("double")
    values = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "BinStart double, BinEnd double, Count bigint")
    start, step, bins = nice_step(low, high, max_bins)
    bin_number = F.least(F.floor((F.col("v") - F.lit(start)) / F.lit(step)), F.lit(bins - 1))
    return values.groupBy(bin_number.alias("b")).agg(F.count(F.lit(1)).alias("Count")).select(
        (F.lit(start) + F.col("b") * F.lit(step)).alias("BinStart"),
        (F.lit(start) + (F.col("b") + 1) * F.lit(step)).alias("BinEnd"),
        "Count",
    )


def client_feature_counts(usage: DataFrame) -> DataFrame:
    """Requests per client and feature in long form: the form that scales with either."""
    keys = ["ClientName", "FeatureName"]
    return keyed(usage, *keys).groupBy(*keys).agg(F.count("UsageID").alias("Requests"))


def client_feature_heatmap(usage: DataFrame, features: Sequence[str]) -> DataFrame:
    """Requests per client, one column per given feature in sorted order, 0 where there are none."""
    wanted = sorted(features)
    return (
        keyed(usage, "ClientName", "FeatureName")
        .groupBy("ClientName").pivot("FeatureName", wanted).agg(F.count("UsageID")).na.fill(0, wanted)
    )


# The measures of the scorecard, the column of each, and whether more is better.
SCORECARD = {
    "Cost": ("TotalCost", False),
    "Latency": ("AvgLatency", False),
    "Satisfaction": ("AvgSatisfaction", True),
    "Token Efficiency": ("AvgTokenEfficiency", True),
    "Success Rate": ("SuccessRate", True),
}


def model_scorecard(models: DataFrame, expected_models: int | None = None, key: str = "ModelName") -> DataFrame:
    """Five measures per model scaled to 0..1, better is higher; a constant measure is 0.5.

    One row per model is kept, the one with the lowest figures if names repeat.
    """
    measures = [c for c, _ in SCORECARD.values()]
    require_columns(models, [key, *measures], "model table")
    first = models.groupBy(key).agg(F.min(F.struct(*measures)).alias("m")).select(key, "m.*")
    if expected_models is not None and (found := first.count()) != expected_models:
        raise ValueError(f"expected {expected_models} models for the scorecard, found {found}")
    ends = first.agg(*[f(c).alias(f"{n}_{c}") for c in measures for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = []
    for label, (c, higher_is_better) in SCORECARD.items():
        low, high = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if low is None or low == high:
            scaled = F.lit(0.5)
        else:
            scaled = (F.col(c) - F.lit(low)) / F.lit(high - low)
        out.append((scaled if higher_is_better else 1.0 - scaled).alias(label))
    return first.select(key, *out)


# --- business measures ---------------------------------------------------------------

def business_measures(usage: DataFrame, high_latency_ms: float) -> DataFrame:
    """Request, latency and cost measures as one row; ratios are NULL without requests.

    What counts as high latency has no standard value, so the caller gives it.
    The median is exact.
    """
    median = quantiles(usage, {"LatencyMs": (0.5,)})["LatencyMs"][0.5]
    requests, cost = F.count(F.lit(1)), F.sum("CostUSD")
    tokens_k = F.sum("TotalTokens") / 1000
    return usage.agg(
        requests.alias("TotalRequests"),
        C.ratio(F.count_if(F.col("SuccessFlag") == 1), requests).alias("SuccessRate"),
        F.count_if(F.col("SuccessFlag") == 0).alias("FailedRequests"),
        F.lit(median).cast("double").alias("MedianLatency"),
        C.ratio(F.count_if(F.col("LatencyMs") > high_latency_ms), requests).alias("HighLatencyShare"),
        C.as_double(cost).alias("TotalCost"),
        C.ratio(cost, requests).alias("CostPerRequest"),
        C.ratio(cost, tokens_k).alias("CostPer1KTokens"),
    )


def flag_patterns(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How often each combination of flags occurs, most frequent first."""
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("Count")).orderBy(F.desc("Count"), *[F.desc(f) for f in flags])
