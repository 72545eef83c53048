"""Exact distinct members as bitmaps that merge.

Members (clients, models) get dense numbers once. A set is then rows of
``bucket, Members``: one bitmap of 32,768 bits per bucket that it touches. Sets of
months merge, intersect and count without going back to the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.ranking import row_index
from meterstar.session import materialise

NUMBER, BUCKET, MEMBERS = "MemberNumber", "Bucket", "Members"


def number_members(members: DataFrame, order: Sequence[Column], known: DataFrame | None = None) -> DataFrame:
    """Add dense numbers from 1, in ``order``; rows of distinct members.

    With ``known`` (members numbered before) their numbers stand: only members that it lacks
    are returned, numbered after its last. Members that are close in ``order`` share
    buckets, so ordering by cohort keeps each cohort's bitmaps few.
    """
    if known is None:
        return row_index(members, order, NUMBER)
    keys = [c for c in known.columns if c != NUMBER]
    last = known.agg(F.coalesce(F.max(NUMBER), F.lit(0)).alias("n"))
    new = row_index(members.join(known, keys, "left_anti"), order, NUMBER)
    return new.withColumn(NUMBER, F.col(NUMBER) + last.scalar())


def member_sets(rows: DataFrame, groups: Sequence[str], member: str, numbers: DataFrame, parts: int | None = None) -> DataFrame:
    """Sets of the members seen in each group: ``groups, Bucket, Members``.

    Pairs become distinct before they are shuffled on, so neither a frequent member nor a large group meets in
    one task as raw rows. Rows without a member, or with one that has no number, belong to no set.
    ``parts`` (see ``session.task_parts``) is the number of tasks for many pairs.
    """
    pairs = rows.select(*groups, member).where(F.col(member).isNotNull()).distinct()
    if parts:
        pairs = pairs.repartition(parts, member)
    placed = pairs.join(numbers.select(member, NUMBER), member).select(
        *groups, F.bitmap_bucket_number(NUMBER).alias(BUCKET), F.bitmap_bit_position(NUMBER).alias("_bit"))
    if parts:
        # At most a bitmap's bits meet in a group's bucket, and no half-filled bitmaps of every task are sent.
        placed = placed.repartition(parts, *groups, BUCKET)
    return placed.groupBy(*groups, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(MEMBERS))


def merge_sets(sets: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Unions of sets per group, for instance of a group's months."""
    return sets.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS))


def count_members(sets: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Exact number of distinct members per group; sets of one group are merged first."""
    return merge_sets(sets, groups).groupBy(*groups).agg(
        F.coalesce(F.sum(F.bitmap_count(MEMBERS)), F.lit(0)).cast("bigint").alias(name)
    )


def shared_members(a: DataFrame, b: DataFrame, groups: Sequence[str], name: str, where: Column | None = None) -> DataFrame:
    """Number of members that a set of ``a`` shares with one of ``b``, for each pair that shares a bucket.

    ``groups`` names the group columns of both sides (no name on both); each side has one row per group and bucket.
    """
    pairs = a.select(*[c for c in a.columns if c != MEMBERS], F.col(MEMBERS).alias("_a")).join(
        b.select(*[c for c in b.columns if c != MEMBERS], F.col(MEMBERS).alias("_b")), BUCKET)
    pairs = pairs if where is None else pairs.where(where)
    both = pairs.select(*groups, BUCKET, F.explode(F.array("_a", "_b")).alias(MEMBERS))
    both = both.groupBy(*groups, BUCKET).agg(F.bitmap_and_agg(MEMBERS).alias(MEMBERS))
    return both.groupBy(*groups).agg(F.sum(F.bitmap_count(MEMBERS)).cast("bigint").alias(name))


def adoption_funnel(sets: DataFrame) -> DataFrame:
    """``analyses.feature_adoption_funnel`` from client sets per feature (and month, or any finer group)."""
    sets = materialise(merge_sets(sets, ["FeatureKey", "FeatureName"]))
    clients = count_members(sets, [], "n")
    return count_members(sets, ["FeatureKey", "FeatureName"], "AdoptingClients").withColumn(
        "AdoptionPct", C.ratio(F.col("AdoptingClients") * 100.0, clients.scalar())
    )


def retention(sets: DataFrame, clients: DataFrame) -> DataFrame:
    """``analyses.cohort_retention`` from client sets per Month and numbered clients ``CohortMonth, MemberNumber``.

    A cohort's size is what it shares with the union of all months; a
    month's active clients are what it shares with that month. Clients without a cohort count nowhere.
    """
    months = materialise(merge_sets(sets, ["Month"]).withColumnRenamed("Month", "ActivityMonth"))
    cohorts = materialise(clients.where("CohortMonth IS NOT NULL").groupBy(
        "CohortMonth", F.bitmap_bucket_number(NUMBER).alias(BUCKET)
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(MEMBERS)))
    sizes = shared_members(cohorts, merge_sets(months), ["CohortMonth"], "CohortSize")
    active = shared_members(cohorts, months, ["CohortMonth", "ActivityMonth"], "ActiveClients",
                            F.col("ActivityMonth") >= F.col("CohortMonth")).where("ActiveClients > 0")
    return active.join(sizes, "CohortMonth").select(
        "CohortMonth", "ActivityMonth", "CohortSize", "ActiveClients",
        C.ratio(F.col("ActiveClients") * 100.0, "CohortSize").alias("RetentionPct"),
    )
