import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from meterstar import session
from meterstar.operators import analyses, enrich, kpis, scoring
from meterstar.sources import samples, sinks, star
from meterstar.sources.contracts import FILES, contract

SF = "/root/testdata/sf0.001"


def test_star_needs_all_tables(make_star):
    tables = dict(make_star())
    tables.pop("region")
    with pytest.raises(KeyError, match="region"):
        star.StarTables(tables)


def test_views_answer_sql(spark, make_star):
    make_star([{}, {"CostUSD": 0.15}]).register_views()
    query = f"SELECT sum(CostUSD) FROM {FILES['fact']} f JOIN {FILES['region']} r USING (RegionKey) WHERE r.RegionName = 'Alps'"
    assert spark.sql(query).first()[0] == pytest.approx(0.27)


def test_parquet_star_round_trip(spark, make_star, tmp_path):
    original = make_star()
    for name, df in original.items():
        df.write.parquet(str(tmp_path / f"{FILES[name]}.parquet"))
    loaded = star.typed(star.load_star(spark, str(tmp_path), "parquet"))
    assert loaded.fact.collect() == original.fact.collect()
    assert set(loaded.dimensions) == {"date", "client", "model", "feature", "region", "subscription"}


def test_typing_text(spark):
    df = spark.createDataFrame([("4.0", "x", "nan", "1"), ("7", "2", "1.5", None)],
                               "UsageID string, DateKey string, CostUSD string, Extra string")
    rows = star.typed_table(df, "fact").collect()
    assert [r["UsageID"] for r in rows] == [4, 7] and [r["DateKey"] for r in rows] == [None, 2]
    assert [r["CostUSD"] for r in rows] == [None, 1.5] and [r["Extra"] for r in rows] == ["1", None]


def test_contract_names_its_key():
    assert contract("client").key == "ClientKey" and contract("fact").key is None
    assert "SatisfactionScore" in contract("fact").columns


def test_master_is_checked(spark, tmp_path):
    path = str(tmp_path / "master")
    with pytest.raises(FileNotFoundError):
        star.load_master(spark, path, ["Date"])
    days = spark.createDataFrame([(dt.date(2025, 1, 1), 1), (None, 2)], "Date date, UsageID int")
    sinks.write_table(days, path)
    with pytest.raises(star.MissingColumnsError, match="CostUSD"):
        star.load_master(spark, path, ["Date", "CostUSD"])
    with pytest.raises(ValueError, match="missing values"):
        star.reject_null_dates(star.load_master(spark, path, ["Date"]))


def test_writers(spark, tmp_path):
    df = spark.range(100).withColumn("Month", F.when(F.col("id") % 3 == 0, "2025-01").otherwise("2025-02"))
    sinks.write_by_month(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).where("Month = '2025-01'").count() == 34
    sinks.write_tables({"a": df, "b": df.limit(1)}, str(tmp_path / "t"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "t" / "b")).columns == ["id", "Month"]


def test_materialised_tables_live_in_the_shared_folder(spark):
    stored = session.materialise(spark.range(5))
    assert all(session.shared_folder(spark).split(":")[-1] in f for f in stored.inputFiles()) and stored.count() == 5


def test_ordered_lists(spark):
    df = spark.createDataFrame([(1, 2.0, True), (2, 9.0, True), (3, None, False), (4, 9.0, False)],
                               "UsageID int, StatisticalAnomalyScore double, IsStatisticalAnomaly boolean")
    assert [r["UsageID"] for r in kpis.by_value(df, "StatisticalAnomalyScore", "UsageID").collect()] == [2, 4, 1, 3]
    assert [r["UsageID"] for r in scoring.ranked_anomalies(df).collect()] == [2, 1]
    assert "AnomalyScore" in scoring.with_short_names(df).columns
    summary = spark.createDataFrame([("a", 5), ("b", 0), ("c", 2)], "Pattern string, Count int")
    assert [r["Pattern"] for r in kpis.positive_counts(summary).collect()] == ["c", "a"]


def test_both_sample_stars_satisfy_the_contracts(spark):
    for tables in (samples.shipments(spark, SF), samples.requests(spark, SF)):
        for name in FILES:
            assert set(contract(name).columns) <= set(tables[name].columns)
    assert enrich.enrich(samples.requests(spark, SF)).count() == samples.table(spark, SF, "events").count()


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_analyses_do_not_depend_on_partitioning(usage_star, partitions):
    usage = enrich.fact_view(usage_star.replace(fact=usage_star.fact.repartition(partitions)))
    want = enrich.fact_view(usage_star)
    for analysis in (analyses.client_rfm, analyses.model_cost_efficiency, analyses.cohort_retention, analyses.upsell_candidates):
        def rounded(df):
            return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
        assert rounded(analysis(usage)) == rounded(analysis(want))


def test_model_without_tokens_ranks_last(spark):
    usage = spark.createDataFrame([(1, "a", "P", 1.0, 0), (2, "b", "P", 5.0, 100), (3, "c", "P", 1.0, 100)],
                                  "ModelKey int, ModelName string, Provider string, CostUSD double, TotalTokens int")
    got = {r["ModelKey"]: r["ProviderCostRank"] for r in analyses.model_cost_efficiency(usage).collect()}
    assert got == {3: 1, 2: 2, 1: 3}


def test_correlation_without_variance_is_null(spark):
    usage = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "CostUSD double, SatisfactionScore double")
    assert analyses.cost_satisfaction_correlation(usage).first()[0] is None


def test_line_items_move_once_and_by_order_alone(spark, capsys):
    """Whatever the sizes: no join deals the fact out by the few keys of a small table or by its clients."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        usage = samples.usage(spark, "/root/testdata/sf0.001", "shipments", "client", "feature", "subscription")
        usage.select("UsageID", "ClientName", "FeatureName", "TierName", "Month").explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(FeatureKey" not in plan and "hashpartitioning(SubscriptionTierKey" not in plan
    assert plan.count("hashpartitioning(l_orderkey") == 1
    top = plan[: plan.index("hashpartitioning(l_orderkey")]
    assert "hashpartitioning(ClientKey" not in top and "hashpartitioning(c_custkey" not in top


def test_tasks_hold_a_bounded_number_of_rows(spark):
    assert session.task_parts(spark, 216_000_000) == 432 and session.task_parts(spark, 0) == spark.sparkContext.defaultParallelism


def test_orders_meet_their_clients_in_bounded_tasks(spark, monkeypatch, capsys):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    usage = samples.usage(spark, "/root/testdata/sf0.001", "shipments", "subscription")
    usage.select("UsageID", "TierName").explain()
    dealt = re.findall(r"hashpartitioning\(ClientKey#\d+L?, (\d+)\), REPARTITION_BY_NUM", capsys.readouterr().out)
    assert dealt == [str(-(-orders // 100))] * 2 and orders > 400
