import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterstar.operators import aggregates, analyses, enrich, members
from meterstar.plans import refresh
from meterstar.sources.snapshots import Snapshot


def numbers_of(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("ClientKey"), F.col("id").alias(members.NUMBER))


def plain(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def same_tables(snapshot, master):
    wanted = aggregates.build_aggregates(master)
    for name, table in refresh.reporting_tables(snapshot).items():
        assert sorted(table.columns) == sorted(wanted[name].columns), name
        columns = sorted(table.columns)
        assert plain(table.select(columns).collect()) == plain(wanted[name].select(columns).collect()), name
    return True


def test_sets_count_across_buckets(spark):
    """Members on both sides of a bucket's end, repeated rows, missing members and members without a number."""
    rows = spark.createDataFrame(
        [("a", 1), ("a", 32768), ("a", 32769), ("a", 32769), ("b", 32769), ("b", None), ("b", 90000), (None, 7)], "g string, ClientKey bigint")
    sets = members.member_sets(rows, ["g"], "ClientKey", numbers_of(spark, 70000))
    assert plain(members.count_members(sets, ["g"], "n").collect()) == plain([("a", 3), ("b", 1), (None, 1)])
    assert members.count_members(sets, [], "n").first()["n"] == 4
    assert members.count_members(sets.limit(0), [], "n").first()["n"] == 0


def test_shared_members(spark):
    numbers = numbers_of(spark, 70000)
    a = spark.createDataFrame([("x", k) for k in (1, 2, 40000)] + [("y", 5)], "p string, ClientKey bigint")
    b = spark.createDataFrame([("m", k) for k in (2, 40000, 69999)] + [("n", 69999)], "q string, ClientKey bigint")
    sets = [members.member_sets(df, [g], "ClientKey", numbers) for df, g in ((a, "p"), (b, "q"))]
    out = {(r["p"], r["q"]): r["n"] for r in members.shared_members(*sets, ["p", "q"], "n").collect()}
    assert out == {("x", "m"): 2, ("y", "m"): 0}


def test_numbers_grow_and_stay(spark):
    first = members.number_members(spark.createDataFrame([(5,), (3,)], "k int"), [F.asc("k")])
    more = members.number_members(spark.createDataFrame([(4,), (3,), (9,)], "k int"), [F.asc("k")], first)
    assert plain(first.collect()) == [(3, 1), (5, 2)]
    assert plain(more.collect()) == [(4, 3), (9, 4)]


def test_sets_give_what_requests_give(usage_star):
    usage = enrich.enrich(usage_star)
    clients = usage.groupBy("ClientKey").agg(F.date_format(F.min("OnboardingDate"), "yyyy-MM").alias("CohortMonth"))
    numbers = members.number_members(clients, [F.asc("CohortMonth"), F.asc("ClientKey")])
    sets = members.member_sets(usage, ["FeatureKey", "FeatureName", "Month"], "ClientKey", numbers)
    assert plain(members.adoption_funnel(sets).collect()) == plain(analyses.feature_adoption_funnel(usage).collect())
    columns = ["CohortMonth", "ActivityMonth", "CohortSize", "ActiveClients", "RetentionPct"]
    wanted = analyses.cohort_retention(usage).select(columns).collect()
    assert plain(members.retention(sets, numbers).select(columns).collect()) == plain(wanted)


def test_refreshing_months_equals_a_full_build(spark, usage_star, tmp_path):
    master = enrich.enrich(usage_star)
    late = F.col("Month") >= "2025-03"
    refresh.refresh(spark, str(tmp_path), master.where(~late))
    refresh.refresh(spark, str(tmp_path), master.where(late & (F.col("UsageID") % 2 == 0)))  # to be corrected
    snapshot = refresh.refresh(spark, str(tmp_path), master.where(late))
    assert snapshot.number == 3 and snapshot.months("client_month") == ["2025-01", "2025-02", "2025-03", "2025-04"]
    assert same_tables(snapshot, master)
    assert snapshot.read("fact_master").count() == master.count()
    removed = refresh.refresh(spark, str(tmp_path), master.where("Month = '2025-01'"), removed=["2025-02"])
    assert same_tables(removed, master.where("Month <> '2025-02'"))
    assert same_tables(snapshot, master)  # a reader of the older snapshot goes on


def test_months_enriched_alone(make_star, usage_star, spark, tmp_path):
    """A month's rows need no other month: totals, quotas and tables are those of the whole."""
    dates = usage_star["date"].where("Date >= '2025-02-01'").select("DateKey")
    part = usage_star.replace(fact=usage_star.fact.join(dates, "DateKey", "left_semi"))
    rest = usage_star.replace(fact=usage_star.fact.join(dates, "DateKey", "left_anti"))
    refresh.refresh_from_star(rest, str(tmp_path))
    snapshot = refresh.refresh_from_star(part, str(tmp_path))
    columns = ["UsageID", "MonthlyTokensUsed", "QuotaUtilizationPct"]
    whole = enrich.enrich(usage_star)
    assert plain(snapshot.read("fact_master").select(columns).collect()) == plain(whole.select(columns).collect())
    assert same_tables(snapshot, whole)


def test_a_broken_refresh_changes_nothing(spark, usage_star, tmp_path, monkeypatch):
    master = enrich.enrich(usage_star)
    early = master.where("Month < '2025-03'")
    refresh.refresh(spark, str(tmp_path), early)

    def broken(*_):
        raise OSError("executors lost")

    with monkeypatch.context() as m:
        m.setattr(members, "member_sets", broken)
        with pytest.raises(OSError):
            refresh.refresh(spark, str(tmp_path), master)
    assert Snapshot(spark, str(tmp_path)).number == 1
    assert same_tables(Snapshot(spark, str(tmp_path)), early)
    assert same_tables(refresh.refresh(spark, str(tmp_path), master), master)


def test_refreshes_from_one_manifest_conflict(spark, usage_star, tmp_path):
    master = enrich.enrich(usage_star).where("Month = '2025-01'")
    first = Snapshot(spark, str(tmp_path))
    refresh.refresh(spark, str(tmp_path), master, tables=["agg_region_monthly"], keep_master=False)
    staged = first.stage("region_month", aggregates.region_monthly(master))
    with pytest.raises(Exception, match="(?i)already exists"):
        first.publish([staged], ["2025-01"])
    with pytest.raises(ValueError, match="old months"):
        refresh.refresh(spark, str(tmp_path), master, tables=["agg_client_monthly"], keep_master=False)


def test_missing_keys_months_and_rows(make_star, spark, tmp_path):
    """Rows without a known day, client or feature, and a refresh without rows."""
    star = make_star([{}, {"DateKey": 1}, {"ClientKey": None}, {"ClientKey": 99, "FeatureKey": 8}, {"FeatureKey": None, "ClientKey": 4}])
    master = enrich.enrich(star)
    empty = refresh.refresh(spark, str(tmp_path), master.limit(0))
    assert {n: t.count() for n, t in refresh.reporting_tables(empty).items()} == dict.fromkeys(refresh.TABLES, 0)
    assert same_tables(refresh.refresh(spark, str(tmp_path), master), master)


def test_cost_anomalies_are_named_after_the_limit(spark, make_star):
    clients = [(k, f"CLI-{k}", f"N{k}", "I", "S", dt.date(2025, 1, 1), "A", "Active") for k in (1, 2)]
    facts = [{"CostUSD": 0.1} for _ in range(20)] + [{"CostUSD": 9.0, "ClientKey": 2}, {"CostUSD": 50.0, "ClientKey": 77}]
    star = make_star(facts, client=clients)
    usage = star.fact.join(star["date"].select("DateKey", "Date"), "DateKey")
    rows = analyses.cost_anomalies(usage, star["client"], star["model"]).collect()
    assert [(r["UsageID"], r["ClientName"], r["ModelName"]) for r in rows] == [(21, "N2", "Heron")]


def test_only_the_columns_of_the_wanted_tables_are_stored(spark, usage_star, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(refresh, "materialise", lambda df, real=refresh.materialise: stored.append(df.columns) or real(df))
    master = enrich.enrich(usage_star)
    for name in refresh.TABLES:
        stored.clear()
        snapshot = refresh.refresh(spark, str(tmp_path / name), master, tables=[name], keep_master=False)
        assert stored[0] == ["Month", *[c for c in refresh.READS[name]]] and len(stored[0]) < 13
        wanted, got = aggregates.build_aggregates(master)[name], refresh.reporting_tables(snapshot, [name])[name]
        columns = sorted(wanted.columns)
        assert plain(got.select(columns).collect()) == plain(wanted.select(columns).collect())


def test_sets_and_upsell_in_a_given_number_of_tasks(spark, usage_star):
    usage = enrich.enrich(usage_star).drop("MonthlyTokensUsed")
    numbers = members.number_members(usage.select("ClientKey").distinct(), [F.asc("ClientKey")])
    sets = [members.member_sets(usage, ["FeatureKey"], "ClientKey", numbers, parts=parts) for parts in (None, 7)]
    assert sets[0].exceptAll(sets[1]).isEmpty() and sets[1].exceptAll(sets[0]).isEmpty()
    found = [analyses.upsell_candidates(usage, parts=parts) for parts in (None, 7)]
    assert not found[0].isEmpty() and plain(found[0].collect()) == plain(found[1].collect())
