"""Refresh the master and the reporting tables month by month.

Client-month and region-month tables are complete within a month. Models and features
span months, so each month keeps their sums, and their clients as bitmaps; the
reporting tables are merged from those, never from the requests of other months.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators import aggregates, members
from meterstar.operators.enrich import enrich
from meterstar.session import materialise
from meterstar.sources.snapshots import NO_MONTH, Snapshot
from meterstar.sources.star import StarTables, typed

MODEL = ["ModelKey", "ModelName", "Provider"]
FEATURE = ["FeatureKey", "FeatureName", "IsPremium"]
TABLES = ("agg_client_monthly", "agg_model_performance", "agg_region_monthly", "agg_feature_adoption")
# Output column of a mean and the column it averages.
MODEL_MEANS = {"AvgLatency": "LatencyMs", "SuccessRate": "SuccessFlag", "AvgSatisfaction": "SatisfactionScore",
               "AvgTokenEfficiency": "TokenEfficiencyRatio"}
FEATURE_MEANS = {"AvgSatisfactionByFeature": "SatisfactionScore"}
# Columns of the master that each reporting table reads besides the month.
_VOLUME = ("CostUSD", "TotalTokens", "UsageID", "LatencyMs", "SuccessFlag")
READS = {
    "agg_client_monthly": ("ClientKey", "ClientName", *_VOLUME, "SatisfactionScore", "ModelKey", "IsPremium"),
    "agg_region_monthly": ("RegionKey", "RegionName", *_VOLUME),
    "agg_model_performance": (*MODEL, *MODEL_MEANS.values(), "CostUSD", "UsageID"),
    "agg_feature_adoption": (*FEATURE, *FEATURE_MEANS.values(), "UsageID", "ClientKey"),
}


def _sums(means: dict[str, str]) -> list[Column]:
    """What a mean needs to merge: its sum and its count."""
    return [c for name, of in means.items()
            for c in (F.sum(C.as_double(of)).alias(f"{name}_sum"), F.count(of).alias(f"{name}_n"))]


def _mean(name: str) -> Column:
    return C.ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name)


def model_months(master: DataFrame) -> DataFrame:
    """Sums per model and month."""
    return master.groupBy(*MODEL, "Month").agg(
        *_sums(MODEL_MEANS), F.sum("CostUSD").alias("Cost"), F.count("UsageID").alias("Requests"))


def merged_models(months: DataFrame) -> DataFrame:
    """``aggregates.model_performance`` from the sums of months."""
    models = materialise(aggregates.keyed(months, *MODEL).groupBy(*MODEL).agg(
        _mean("AvgLatency"), (_mean("SuccessRate") * 100.0).alias("SuccessRate"), _mean("AvgSatisfaction"),
        C.total("Cost").alias("TotalCost"), F.sum("Requests").alias("TotalRequests"), _mean("AvgTokenEfficiency"),
    ))
    return aggregates.ranked_models(models)


def feature_months(master: DataFrame) -> DataFrame:
    """Sums per feature and month."""
    return master.groupBy(*FEATURE, "Month").agg(*_sums(FEATURE_MEANS), F.count("UsageID").alias("Requests"))


def merged_features(months: DataFrame, sets: DataFrame) -> DataFrame:
    """``aggregates.feature_adoption`` from the sums and the client sets of months."""
    sets = materialise(members.merge_sets(sets, FEATURE))
    clients = members.count_members(sets, [], "n")
    adopting = members.count_members(aggregates.keyed(sets, *FEATURE), FEATURE, "_clients")
    used = aggregates.keyed(months, *FEATURE).groupBy(*FEATURE).agg(
        F.sum("Requests").alias("UsageCount"), _mean("AvgSatisfactionByFeature"))
    # A feature whose requests name no client has no set.
    adoption = C.ratio(F.coalesce("_clients", F.lit(0)), clients.scalar()) * 100.0
    return used.join(adopting, FEATURE, "left").withColumn("PremiumAdoptionRate", adoption).drop("_clients")


def _clients(snapshot: Snapshot, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers of all clients so far, and those that are new in ``master``."""
    seen = master.select("ClientKey").where("ClientKey IS NOT NULL").distinct()
    if "client_numbers" not in snapshot.tables():
        new = materialise(members.number_members(seen, [F.asc("ClientKey")]))
        return new, new
    known = snapshot.read("client_numbers").drop("Month")
    new = materialise(members.number_members(seen, [F.asc("ClientKey")], known))
    return known.unionByName(new), new


def refresh(spark: SparkSession, folder: str, master: DataFrame, removed: Iterable[str] = (),
            tables: Sequence[str] = TABLES, keep_master: bool = True) -> Snapshot:
    """Replace the months that ``master`` holds, all of their rows given, and publish a new snapshot.

    ``master`` has the columns of the enriched master that the reporting tables read. Months in ``removed`` go, other months are
    not read. Rows without a month are a month of their own. ``tables`` names the reporting tables to keep up; without ``keep_master`` the
    rows themselves are not kept.
    """
    snapshot = Snapshot(spark, folder)
    staged = []
    if keep_master:
        rows = snapshot.stage("fact_master", master)
        staged.append(rows)
        master = rows.read(spark)
    else:
        master = materialise(master.select(*dict.fromkeys(["Month", *[c for name in tables for c in READS[name]]])))
    # One row per month.
    changed = {r[0] for r in master.select(F.coalesce("Month", F.lit(NO_MONTH))).distinct().collect()} | set(removed)
    if "agg_client_monthly" in tables:
        staged.append(snapshot.stage("client_month", aggregates.client_monthly(master)))
    if "agg_region_monthly" in tables:
        staged.append(snapshot.stage("region_month", aggregates.region_monthly(master)))
    if "agg_model_performance" in tables:
        staged.append(snapshot.stage("model_month", model_months(master)))
    if "agg_feature_adoption" in tables:
        numbers, new = _clients(snapshot, master)
        staged.append(snapshot.stage("feature_month", feature_months(master)))
        sets = members.member_sets(master, [*FEATURE, "Month"], "ClientKey", numbers)
        staged.append(snapshot.stage("feature_clients", sets))
        # Numbers only grow: each refresh adds those of its new clients, under a label of its own.
        label = f"numbered-{snapshot.number + 1:08d}"
        staged.append(snapshot.stage("client_numbers", new.withColumn("Month", F.lit(label))))
        changed.add(label)
    return snapshot.publish(staged, changed)


def reporting_tables(snapshot: Snapshot, tables: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """The reporting tables of a snapshot, as ``aggregates.build_aggregates`` gives them over all its months."""
    build = {
        "agg_client_monthly": lambda: snapshot.read("client_month"),
        "agg_region_monthly": lambda: snapshot.read("region_month"),
        "agg_model_performance": lambda: merged_models(snapshot.read("model_month")),
        "agg_feature_adoption": lambda: merged_features(snapshot.read("feature_month"), snapshot.read("feature_clients")),
    }
    return {name: build[name]() for name in tables}


def refresh_from_star(tables: StarTables, folder: str, removed: Iterable[str] = ()) -> Snapshot:
    """Enrich a star whose fact holds whole months, and refresh them.

    Running totals and quotas start anew each month, so a month is enriched without the others.
    """
    return refresh(tables.fact.sparkSession, folder, enrich(typed(tables)), removed)
