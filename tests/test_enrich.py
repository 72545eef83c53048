import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterstar import session
from meterstar.functions import columns as C
from meterstar.functions.holidays import is_us_holiday
from meterstar.operators import aggregates, enrich, kpis


def master(star):
    return enrich.enrich(star)


def test_rows_are_kept_and_columns_added(make_star):
    star = make_star([{}, {"ClientKey": 99}])
    out = master(star)
    assert out.count() == 2
    assert {"CostVariance", "PeakHour", "MonthlyTokensUsed", "ClientAgeCohort"} <= set(out.columns)
    assert len(out.columns) == len(set(out.columns))


def test_inner_view_drops_orphans(make_star):
    assert enrich.fact_view(make_star([{}, {"ClientKey": 99}])).count() == 1


def test_repeated_dimension_key_is_rejected(make_star):
    region = [(1, "US", "US", 0.0), (1, "EU", "EU", 0.0)]
    with pytest.raises(enrich.CardinalityError, match="region"):
        master(make_star(region=region))


def test_row_wise_rules(make_star):
    star = make_star([
        {"TokensInput": 0, "LatencyMs": None, "SatisfactionScore": None, "SuccessFlag": 0},
        {"LatencyMs": 399.9, "SatisfactionScore": 3.5, "TimeKey": 900},
        {"LatencyMs": 400.0, "SatisfactionScore": 4.5, "TimeKey": 1759},
        {"LatencyMs": 800.0, "SatisfactionScore": 3.4, "TimeKey": 1800},
    ])
    rows = master(star).orderBy("UsageID").collect()
    assert [r["TokenEfficiencyRatio"] for r in rows] == [0.0, 3.0, 3.0, 3.0]
    assert [r["ResponseSpeedTier"] for r in rows] == ["Slow", "Fast", "Medium", "Slow"]
    assert [r["SatisfactionBucket"] for r in rows] == ["Not Rated", "Mid(3.5-4.4)", "High(4.5-5.0)", "Low(<3.5)"]
    assert [r["PeakHour"] for r in rows] == [True, True, True, False]
    assert [r["CostPerSuccessfulRequest"] for r in rows] == [0.0, 0.12, 0.12, 0.12]
    assert rows[1]["TheoreticalCostUSD"] == pytest.approx(0.08 * 0.02 + 0.24 * 0.05)
    assert rows[1]["CostVariance"] == pytest.approx(0.1064) and rows[1]["IsOverBudget"]
    assert rows[0]["Month"] == "2025-01"


def test_age_cohort_edges(spark):
    days = [None, -5, 30, 31, 90, 91, 180, 181]
    rows = spark.createDataFrame([(d,) for d in days], "d int").select(C.client_age_cohort("d")).collect()
    assert [r[0] for r in rows] == [None, "0-30 days", "0-30 days", "31-90 days", "31-90 days", "91-180 days",
                                    "91-180 days", "180+ days"]


def test_first_week_has_eight_days(make_star):
    clients = [(k, "C", f"N{k}", "I", "S", dt.date(2025, 1, 1) - dt.timedelta(days=k), "A", "Active") for k in (-1, 0, 7, 8)]
    star = make_star([{"ClientKey": k} for k in (-1, 0, 7, 8)], client=clients)
    got = {r["ClientKey"]: r["IsFirstWeekClient"] for r in master(star).collect()}
    assert got == {-1: False, 0: True, 7: True, 8: False}


def test_quota_guards(make_star):
    tiers = [(1, "Basic", 500, 1.5, "S"), (2, "Zero", 0, 2.0, "S")]
    star = make_star([{}, {"TimeKey": 1300}, {"SubscriptionTierKey": 2, "TimeKey": 1400}], subscription=tiers)
    rows = master(star).orderBy("UsageID").collect()
    assert [r["MonthlyTokensUsed"] for r in rows] == [320, 640, 960]
    assert [r["IsOverQuota"] for r in rows] == [False, True, False]
    assert rows[1]["EffectiveCostWithOverage"] == pytest.approx(0.18)
    assert rows[2]["QuotaUtilizationPct"] is None and rows[2]["EffectiveCostWithOverage"] == 0.12


@pytest.mark.parametrize("partitions", [1, 9])
def test_running_total_equals_cumsum(usage_star, partitions):
    df = usage_star.fact.join(usage_star["date"].select("DateKey", "Date"), "DateKey").repartition(partitions)
    df = df.withColumn("Month", C.month_label("Date"))
    got = enrich.running_total(df, ["ClientKey", "Month"], ["Date", "TimeKey"], "UsageID", "TotalTokens", "used")
    want = df.toPandas().sort_values(["ClientKey", "Date", "TimeKey", "UsageID"])
    want["used"] = want.groupby(["ClientKey", "Month"])["TotalTokens"].cumsum()
    assert dict(zip(want["UsageID"], want["used"])) == {r["UsageID"]: r["used"] for r in got.collect()}


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_running_total_over_sparse_ids_and_missing_values(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [("a", 1, k * 2**40, None if k % 3 == 1 else k) for k in range(60)] + [("b", 1, 5, 7), ("c", 1, 1, None), (None, 1, 2, 9)]
        df = spark.createDataFrame(rows, "g string, s int, id bigint, v bigint")
        got = {(r["g"], r["id"]): r["t"] for r in enrich.running_total(df, ["g"], ["s"], "id", "v", "t").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want, total = {("b", 5): 7, ("c", 1): None, (None, 2): None}, 0
    for _, _, i, v in rows[:60]:
        total += v or 0
        want["a", i] = None if v is None else total
    assert got == want


def test_joined_view_is_open_to_sql(spark, make_star):
    enrich.register_views(make_star([{}, {"ClientKey": 99}]))
    assert spark.sql("SELECT sum(MonthlyTokensUsed) FROM fact_master").first()[0] == 320


def test_rows_without_a_client_have_no_running_total(make_star):
    star = make_star([{"ClientKey": None}, {"ClientKey": None}, {}])
    rows = {r["UsageID"]: r["MonthlyTokensUsed"] for r in master(star).collect()}
    assert rows == {1: None, 2: None, 3: 320}


@pytest.mark.parametrize("with_id", [True, False])
def test_month_totals_reach_all_slices_of_a_large_month(spark, monkeypatch, with_id):
    """Rows and totals are dealt out by their number; a client-month above a task's rows is split, and loses none."""
    rows = [(i, 1, "2025-01", i % 50) for i in range(1000)] + [(i, i, "2025-02", 7) for i in range(1000, 1400)]
    rows += [(2000, 1, "2025-01", None), (2001, None, "2025-01", 5), (2002, 5, None, 5), (2003, 9, "2025-03", None), (3, 1, "2025-01", 3)]
    usage = spark.createDataFrame(rows, "UsageID int, ClientKey int, Month string, TotalTokens int")
    usage = usage if with_id else usage.drop("UsageID")
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    monkeypatch.setattr(enrich, "TASK_ROWS", 100, raising=False)
    used = enrich.month_tokens(usage)
    whole = sum(i % 50 for i in range(1000)) + 3
    want = [("2025-01", 1, whole)] * 1002 + [("2025-02", i, 7) for i in range(1000, 1400)] + [("2025-03", 9, None)]
    got = [(r["Month"], r["ClientKey"], r["MonthlyTokensUsed"]) for r in used.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert used.columns == ["ClientKey", "Month", *(["UsageID"] if with_id else []), "TotalTokens", "MonthlyTokensUsed"]
    tasks = used.where("Month = '2025-01'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 501


def test_missing_time_sorts_last_in_the_day(make_star):
    rows = master(make_star([{"TimeKey": None}, {"TimeKey": 2359}])).orderBy("UsageID").collect()
    assert [r["MonthlyTokensUsed"] for r in rows] == [640, 320]


def test_aggregates_match_pandas(usage_star):
    out = master(usage_star)
    frame = out.toPandas()
    tables = aggregates.build_aggregates(out)
    monthly = tables["agg_client_monthly"].toPandas().set_index(["ClientKey", "Month"])
    for (client, month), part in frame.groupby(["ClientKey", "Month"]):
        row = monthly.loc[(client, month)]
        assert row["TotalCost"] == pytest.approx(part["CostUSD"].sum())
        assert row["UniqueModelsUsed"] == part["ModelKey"].nunique()
        assert row["PremiumFeatureUsagePct"] == pytest.approx(part["IsPremium"].mean() * 100)
    models = tables["agg_model_performance"].toPandas()
    assert (models["CostRank"] == models["TotalCost"].rank(method="min", ascending=False)).all()
    assert (models["LatencyRank"] == models["AvgLatency"].rank(method="min")).all()
    adoption = tables["agg_feature_adoption"].toPandas()
    assert (adoption["PremiumAdoptionRate"] == 100).all() and adoption["UsageCount"].sum() == 3000


def test_groups_with_null_keys_are_left_out(make_star):
    assert aggregates.region_monthly(master(make_star([{}, {"RegionKey": 42}]))).agg(F.sum("RequestCount")).first()[0] == 1


def test_empty_overview_and_histogram(make_star):
    empty = make_star().fact.where("false").withColumn("IsAnomaly", F.lit(True))
    row = kpis.overview(empty).first()
    assert (row["requests"], row["cost"], row["success_rate"], row["satisfaction"]) == (0, 0.0, 0.0, None)
    assert kpis.histogram(empty, "LatencyMs").count() == 0
    assert kpis.monthly_trend(empty.withColumn("Date", F.current_date())).columns == [
        "Month", "CostUSD", "TotalTokens", "RequestCount", "SuccessRate"]


def test_risk_bands_keep_empty_bands_and_edges(spark):
    scores = spark.createDataFrame([(1, 0.0), (2, 25.0), (3, 25.1), (4, 100.0), (5, None)], "ClientKey int, ChurnRiskScore double")
    rows = kpis.risk_distribution(scores).orderBy("BandOrder").collect()
    assert [r["Clients"] for r in rows] == [2, 1, 0, 1]


def test_filters_and_lists(spark):
    df = spark.createDataFrame([("EU", "P1", 3.0), ("EU", None, 9.0), ("US", "P2", 5.0)], "RegionName string, Provider string, v double")
    assert kpis.cascade_filter(df, {"RegionName": ["EU"]}).count() == 1
    assert [r[0] for r in kpis.facet_values(df, "Provider").collect()] == ["P1", "P2"]
    assert [r["v"] for r in kpis.top_rows(df, "v", "RegionName", 2).collect()] == [5.0, 9.0]
    flagged = df.withColumn("f", F.col("v") > 4)
    assert kpis.only_flagged(flagged, "f").count() == 2 and kpis.only_flagged(flagged, "f", False).count() == 3
    assert kpis.scatter_points(df, "Provider", "v").count() == 2


@pytest.mark.parametrize("low,high,want", [(0, 100, 10), (0, 4900, 500), (-0.37, 0.21, 0.1), (3, 3, 1.0), (0, 1.7, 0.2)])
def test_bin_widths(low, high, want):
    start, step, bins = kpis.nice_step(low, high)
    assert step == pytest.approx(want) and bins <= 10 and start <= low and start + step * bins >= high - 1e-9


def test_scorecard(spark):
    rows = [("a", 10.0, 5.0, 4.0, 1.0, 99.0), ("b", 20.0, 5.0, 3.0, 2.0, 98.0)]
    models = spark.createDataFrame(rows, "ModelName string, TotalCost double, AvgLatency double, AvgSatisfaction double, AvgTokenEfficiency double, SuccessRate double")
    got = {r["ModelName"]: r for r in kpis.model_scorecard(models, expected_models=2).collect()}
    assert (got["a"]["Cost"], got["b"]["Cost"], got["a"]["Latency"], got["a"]["Satisfaction"]) == (1.0, 0.0, 0.5, 1.0)
    with pytest.raises(ValueError, match="expected 6 models"):
        kpis.model_scorecard(models, expected_models=6)


def test_holidays(spark):
    days = {"2025-01-01": True, "2025-01-20": True, "2025-02-17": True, "2025-05-26": True, "2025-06-19": True,
            "2020-06-19": False, "2025-09-01": True, "2025-10-13": True, "2025-11-27": True, "2021-12-24": True,
            "2021-12-31": True, "2022-12-26": True, "2025-03-17": False}
    df = spark.createDataFrame([(d,) for d in days], "d string").select("d", is_us_holiday(F.to_date("d")).alias("h"))
    assert {r["d"]: r["h"] for r in df.collect()} == days


def test_number_format(spark):
    row = spark.range(1).select(C.format_number(F.lit(1234567.891), 2), C.format_number(F.lit(12.5))).first()
    assert (row[0], row[1]) == ("1,234,567.89", "12")


def test_use_of_a_zero_quota_counts_as_over_on_request(make_star):
    star = make_star([{"TotalTokens": 0}, {"DateKey": 20250101, "TotalTokens": 5}],
                     subscription=[(1, "None", 0, 1.5, "Mail")])
    rows = enrich.enrich(star, zero_quota_is_over=True).orderBy("UsageID").collect()
    assert [r["QuotaUtilizationPct"] for r in rows] == [None, float("inf")]
    assert [r["IsOverQuota"] for r in rows] == [False, True]
    assert [r["EffectiveCostWithOverage"] for r in rows] == [pytest.approx(0.12), pytest.approx(0.18)]
    assert [r["QuotaUtilizationPct"] for r in enrich.enrich(star).orderBy("UsageID").collect()] == [None, None]
