"""The enriched fact: star join, derived columns, running and monthly quota use."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.ranking import PARTITION_SHIFT
from meterstar.session import TASK_ROWS, materialise, task_parts
from meterstar.sources.contracts import DIMENSION_KEYS
from meterstar.sources.star import StarTables

FACT_MASTER = "fact_master"  # fixed value: the view's name

class CardinalityError(ValueError):
    """A dimension key is not unique, so a join would multiply fact rows."""


def check_many_to_one(dimension: DataFrame, key: str, name: str) -> None:
    """Fail if ``key`` repeats in ``dimension``."""
    if not dimension.groupBy(key).count().where("count > 1").isEmpty():
        raise CardinalityError(f"{key} is not unique in the {name} dimension")


def star_join(tables: StarTables, dimensions: Sequence[str] = tuple(DIMENSION_KEYS), how: str = "left",
              validate: bool = True, fact: DataFrame | None = None) -> DataFrame:
    """Join the fact to the named dimensions on their keys.

    A left join keeps every fact row, an inner join drops orphans. Dimensions
    carry no broadcast hint: Catalyst broadcasts those under its size limit and
    sort-merges the others, where adaptive execution splits hot keys.
    """
    joined = tables.fact if fact is None else fact
    for name in dimensions:
        key = DIMENSION_KEYS[name]
        if validate:
            check_many_to_one(tables[name], key, name)
        joined = joined.join(tables[name], key, how)
    return joined


def derive(joined: DataFrame) -> DataFrame:
    """Add the row-wise columns: ratios, theoretical cost, tiers, buckets and month."""
    theoretical = (
        F.col("TokensInput") / 1000 * F.col("CostPer1kInput")
        + F.col("TokensOutput") / 1000 * F.col("CostPer1kOutput")
    )
    days = F.datediff("Date", "OnboardingDate")
    hour = F.floor(F.col("TimeKey") / 100).cast("int")
    return joined.withColumns({
        "TokenEfficiencyRatio": F.when(
            F.col("TokensInput") != 0, C.ratio("TokensOutput", "TokensInput")
        ).when(F.col("TokensInput") == 0, 0.0),
        "CostPerSuccessfulRequest": F.when(F.col("SuccessFlag") == 1, C.as_double("CostUSD")).otherwise(0.0),
        "TheoreticalCostUSD": C.as_double(theoretical),
        "HourOfDay": hour,
        "ResponseSpeedTier": C.response_speed_tier("LatencyMs"),
        "SatisfactionBucket": C.satisfaction_bucket("SatisfactionScore"),
        "DaysSinceOnboarding": days,
        "IsFirstWeekClient": F.coalesce(days.between(*C.FIRST_WEEK_DAYS), F.lit(False)),
        "ClientAgeCohort": C.client_age_cohort(days),
        "Month": C.month_label("Date"),
    }).withColumns({
        "CostVariance": C.as_double("CostUSD") - F.col("TheoreticalCostUSD"),
        "PeakHour": F.coalesce(F.col("HourOfDay").between(*C.PEAK_HOURS), F.lit(False)),
    }).withColumn("IsOverBudget", F.coalesce(F.col("CostVariance") > C.OVER_BUDGET_USD, F.lit(False)))


def running_total(df: DataFrame, group: Sequence[str], slot: Sequence[str], row_id: str, value: str,
                  name: str) -> DataFrame:
    """Cumulative sum of ``value`` per ``group`` in (slot, row_id) order.

    NULL where a group key or the row's own value is NULL. One way for groups of
    any size: the rows are range-sorted once and written; each sort partition
    sums its part of a group, and a group that began in an earlier partition
    adds what those hold. Only the first group of a partition can have begun
    before it, so there is at most one such offset per partition.
    """
    groups = list(group)
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in groups])
    staged = materialise(
        df.orderBy(*groups, *slot, row_id)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", PARTITION_SHIFT))
    )
    parts = staged.where(keyed).groupBy(*groups, "_part").agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # at most one row per sort partition
    offsets = parts.withColumn("_before", F.sum("_sum").over(earlier)).where("_before IS NOT NULL").select(*groups, "_part", "_before")
    # Rows without a group get no total, so each may go to any task.
    within = W.partitionBy("_part", *groups, F.when(~keyed, F.col("_at"))).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    running = staged.withColumn("_within", F.sum(value).over(within)).join(F.broadcast(offsets), [*groups, "_part"], "left")
    total = F.when(keyed & F.col(value).isNotNull(), F.col("_within") + F.coalesce("_before", F.lit(0)))
    return running.select(*[F.col(f"`{c}`") for c in df.columns], total.alias(name))


def running_monthly_tokens(df: DataFrame) -> DataFrame:
    """Add each client's tokens in the month up to and including the request."""
    slotted = df.withColumn("_time", F.coalesce("TimeKey", F.lit(9999)))  # no time sorts last
    out = running_total(slotted, ["ClientKey", "Month"], ["Date", "_time"], "UsageID", "TotalTokens",
                        "MonthlyTokensUsed")
    return out.drop("_time")


def quota_columns(df: DataFrame, zero_quota_is_over: bool = False) -> DataFrame:
    """Add utilisation, the over-quota flag and the cost with overage.

    A zero quota gives no utilisation (NULL) and is not over quota. With
    ``zero_quota_is_over`` any use of a zero quota is infinite utilisation, so over quota; no use of it still gives NULL.
    """
    utilisation = C.ratio("MonthlyTokensUsed", "MonthlyQuotaTokens") * 100.0
    if zero_quota_is_over:
        unlimited = (F.col("MonthlyQuotaTokens") == 0) & (F.col("MonthlyTokensUsed") > 0)
        utilisation = F.when(unlimited, F.lit(float("inf"))).otherwise(utilisation)
    over = F.coalesce(utilisation > 100, F.lit(False))
    return df.withColumns({
        "QuotaUtilizationPct": utilisation,
        "IsOverQuota": over,
        "EffectiveCostWithOverage": C.as_double("CostUSD")
        * F.when(over, F.col("OverageRateMultiplier")).otherwise(1.0),
    })


def enrich(tables: StarTables, validate: bool = True, zero_quota_is_over: bool = False) -> DataFrame:
    """The enriched master: one row per fact row, all attributes, running quota use.

    The running total is taken on the raw fact with only the date attached, so
    that the one shuffle of the fact carries no dimension attributes.
    """
    fact = tables.fact
    if validate:
        check_many_to_one(tables["date"], "DateKey", "date")
    dates = tables["date"].select("DateKey", "Date")
    narrow = fact.join(dates, "DateKey", "left").withColumn("Month", C.month_label("Date"))
    used = running_monthly_tokens(narrow).drop("Date", "Month")
    others = [d for d in DIMENSION_KEYS if d != "date"]
    joined = star_join(tables, ["date"], validate=False, fact=used).drop("Month")
    joined = star_join(tables, others, validate=validate, fact=joined)
    return quota_columns(derive(joined), zero_quota_is_over)


def month_tokens(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Add each client's tokens of the whole month to every row.

    There are nearly as many totals as rows, so both are dealt out by client-month in ``parts`` (see ``session.task_parts``; without it the
    rows are counted), and a task holds only its totals while its rows stream by. Rows of a client-month
    too large for a task go to several, which all get its total. A window would put a client-month in one task.
    """
    keys = ["ClientKey", "Month"]
    parts = parts or task_parts(df.sparkSession, df.count())
    totals = materialise(df.repartition(parts, *keys).groupBy(*keys).agg(
        F.sum("TotalTokens").cast("bigint").alias("MonthlyTokensUsed"), F.ceil(F.count(F.lit(1)) / TASK_ROWS).alias("_slices")
    ))
    split = F.broadcast(totals.where("_slices > 1").select(*keys, "_slices"))  # at most one per TASK_ROWS rows
    drawn = F.xxhash64(*[F.col(f"`{c}`") for c in (["UsageID"] if "UsageID" in df.columns else df.columns)])
    rows = df.join(split, keys, "left").withColumn("_slice", F.coalesce(F.pmod(drawn, "_slices"), F.lit(0).cast("bigint")))
    totals = totals.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1))).drop("_slices")
    placed = [*keys, "_slice"]
    joined = rows.repartition(parts, *placed).join(totals.repartition(parts, *placed).hint("shuffle_hash"), placed)
    return joined.select(*keys, *[F.col(f"`{c}`") for c in df.columns if c not in keys], "MonthlyTokensUsed")


VIEW_COLUMNS = (
    "UsageDate", "ClientName", "OnboardingDate", "ModelName", "Provider", "CostPer1kInput", "CostPer1kOutput",
    "FeatureName", "RegionName", "TierName", "MonthlyQuotaTokens",
)


def fact_view(tables: StarTables) -> DataFrame:
    """The denormalised view for the SQL analyses: inner star join, whole-month quota use."""
    fact = tables.fact
    dates = tables["date"].select("DateKey", F.col("Date").alias("UsageDate"))
    joined = star_join(tables.replace(date=dates), how="inner", validate=False)
    rows = joined.select(*fact.columns, *VIEW_COLUMNS).withColumns(
        {"Date": F.col("UsageDate"), "Month": C.month_label("UsageDate")}
    )
    rows = month_tokens(rows, task_parts(fact.sparkSession, fact.count()))
    return rows.withColumn("QuotaUtilizationPct", C.ratio("MonthlyTokensUsed", "MonthlyQuotaTokens") * 100.0)


def register_views(tables: StarTables) -> None:
    """Expose the seven tables and the joined view to SQL."""
    tables.register_views()
    fact_view(tables).createOrReplaceTempView(FACT_MASTER)
