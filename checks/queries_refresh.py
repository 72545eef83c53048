"""Registered: distinct members as bitmaps, and reporting tables refreshed by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators import members
from meterstar.plans import refresh
from meterstar.session import fresh_folder, materialise

from checks.registry import item_parts, register, rounded, shipped, with_efficiency

LATE = "1997-01"  # months from here on arrive after the others


def _numbered(usage: DataFrame) -> DataFrame:
    """Clients by onboarding month, so that a cohort's bits lie together."""
    clients = usage.groupBy("ClientKey").agg(C.month_label(F.min("OnboardingDate")).alias("CohortMonth"))
    return materialise(members.number_members(clients, [F.asc("CohortMonth"), F.asc("ClientKey")]))


@register("a15_distinct_clients")
def _(spark, sf_dir):
    """Clients per feature and month, and per feature over all months from the same sets."""
    usage = shipped(spark, sf_dir, "client", "feature")
    sets = materialise(members.member_sets(usage, ["FeatureKey", "Month"], "ClientKey", _numbered(usage), item_parts(spark, sf_dir)))
    months = members.count_members(sets, ["FeatureKey", "Month"], "Clients")
    return months.unionByName(members.count_members(sets, ["FeatureKey"], "Clients").withColumn("Month", F.lit(None).cast("string")))


@register("q4_funnel_from_sets")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir, "client", "feature")
    sets = members.member_sets(usage, ["FeatureKey", "FeatureName", "Month"], "ClientKey", _numbered(usage), item_parts(spark, sf_dir))
    return rounded(members.adoption_funnel(sets))


@register("q10_retention_from_sets")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir, "client")
    numbers = _numbered(usage)
    return rounded(members.retention(members.member_sets(usage, ["Month"], "ClientKey", numbers, item_parts(spark, sf_dir)), numbers))


def _refreshed(spark, sf_dir: str, name: str, *dimensions: str) -> DataFrame:
    """One reporting table after three refreshes: early months, late months with rows missing, late months whole."""
    usage = with_efficiency(shipped(spark, sf_dir, *dimensions))
    folder, late = fresh_folder(spark), F.col("Month") >= LATE
    for rows in (usage.where(~late), usage.where(late & (F.col("UsageID") % 3 != 0)), usage.where(late)):
        snapshot = refresh.refresh(spark, folder, rows, tables=[name], keep_master=False)
    return rounded(refresh.reporting_tables(snapshot, [name])[name])


@register("s6_refreshed_client_month")
def _(spark, sf_dir):
    return _refreshed(spark, sf_dir, "agg_client_monthly", "client", "feature")


@register("s6_refreshed_models")
def _(spark, sf_dir):
    return _refreshed(spark, sf_dir, "agg_model_performance", "model")


@register("s6_refreshed_region_month")
def _(spark, sf_dir):
    return _refreshed(spark, sf_dir, "agg_region_monthly", "region")


@register("s6_refreshed_features")
def _(spark, sf_dir):
    return _refreshed(spark, sf_dir, "agg_feature_adoption", "feature")
