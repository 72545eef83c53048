import math
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterstar import session
from meterstar.functions import columns as C
from meterstar.operators import enrich, evaluate, features, isolation, scoring
from meterstar.plans.master import build_master
from meterstar.plans.predict import run_forecasting
from meterstar.plans.score import detect_anomalies, run_scoring
from meterstar.sources.catalog import Catalog


def churn_rows(spark, clients=6):
    rows = [(k, 60 if k % 2 else 5, float(k - 3), 0.1 * k, 0.8 + k / 100, 0.85 + k / 100, 10.0 if k % 2 else 70.0, k * 10.0)
            for k in range(1, clients + 1)]
    return spark.createDataFrame(rows, "ClientKey int, " + ", ".join(f"{c} double" for c in features.CHURN_FEATURES).replace(
        "DaysSinceLastRequest double", "DaysSinceLastRequest int"))


def test_client_features_match_pandas(usage_star):
    master = enrich.enrich(usage_star)
    got = features.churn_features(master).toPandas().set_index("ClientKey").sort_index()
    frame = master.toPandas()
    frame["Date"] = pd.to_datetime(frame["Date"])
    end = frame["Date"].max()
    for client, part in frame.groupby("ClientKey"):
        row = got.loc[client]
        assert row["DaysSinceLastRequest"] == (end - part["Date"].max()).days
        recent = part[part["Date"] >= end - pd.Timedelta(days=30)]["SuccessFlag"].mean()
        assert (np.isnan(recent) and pd.isna(row["SuccessRateLast30Days"])) or row["SuccessRateLast30Days"] == pytest.approx(recent)
        for column, how, value in (("AvgMonthlyCostTrend", "sum", "CostUSD"), ("SatisfactionTrend", "mean", "SatisfactionScore")):
            months = part.groupby("Month")[value].agg(how).dropna()
            x = [int(m[:4]) * 12 + int(m[5:]) for m in months.index]
            want = np.polyfit(x, months, 1)[0] if len(months) > 1 else 0.0
            assert row[column] == pytest.approx(want, abs=1e-8)
        assert row["PremiumFeatureUsagePct"] == pytest.approx(part["IsPremium"].mean() * 100)


def test_client_features_are_dealt_out_by_the_number_of_requests(spark, monkeypatch):
    """Partitions follow the rows, so that no task's groups grow with the input, whatever the session's number of partitions."""
    master = spark.range(3000).select(
        (F.col("id") % 700).alias("ClientKey"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("Date"),
        F.lit(1.0).alias("CostUSD"), F.lit(3.0).alias("SatisfactionScore"), F.lit(1).alias("SuccessFlag"),
        F.lit(True).alias("IsPremium"), F.col("id").cast("double").alias("QuotaUtilizationPct"),
    )
    want = {r["ClientKey"]: pytest.approx(list(r), abs=1e-9) for r in features.churn_features(master).collect()}
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    dealt = features.churn_features(master)
    assert {r["ClientKey"]: list(r) for r in dealt.collect()} == want and len(want) == 700
    tasks = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 20 and max(r["count"] for r in tasks) < 100


def test_slope_of_one_point_and_of_one_period_is_zero(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 2, 1.0), ("b", 2, 9.0), ("c", 1, None), ("c", 2, 3.0)], "k string, x int, y double")
    assert {r["s"] for r in df.groupBy("k").agg(features.slope("y", "x").alias("s")).collect()} == {0.0}


def test_risk_scores_are_bounded_and_repeatable(spark):
    first = scoring.score_risk(churn_rows(spark))
    again = scoring.score_risk(churn_rows(spark).repartition(3))
    rows = first.scores.orderBy("ClientKey").collect()
    assert rows == again.scores.orderBy("ClientKey").collect()
    assert first.scores.columns == ["ClientKey", "ChurnRiskScore"]
    assert all(0 <= r["ChurnRiskScore"] <= 100 for r in rows)
    assert rows[0]["ChurnRiskScore"] > 50 > rows[1]["ChurnRiskScore"]


def test_logistic_fit_matches_its_objective(spark):
    """The fit minimises the summed loss plus half the squared weights, intercept free."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(200):
        days, quota = float(rng.integers(0, 90)), float(rng.integers(0, 60))
        rows.append((k, days, *map(float, rng.normal(0, 1, 4)), quota, float(rng.integers(0, 100))))
    df = spark.createDataFrame(rows, "ClientKey int, " + ", ".join(f"{c} double" for c in features.CHURN_FEATURES))
    labelled = scoring._filled(df)
    model = scoring.fit_risk_model(labelled)
    frame = labelled.toPandas()
    x = frame[list(features.CHURN_FEATURES)].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = frame["ChurnSignal"].to_numpy()
    w = np.zeros(x.shape[1] + 1)
    design = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([0.0, *np.ones(x.shape[1])])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (p - y) + penalty @ w)
    np.testing.assert_allclose([c for _, c in model.coefficients()], w[1:], atol=2e-3)


def test_probabilities_are_those_of_the_model_without_its_functions(spark, capsys):
    """Scoring plans hold no user-defined function, and repeat what the fitted classifier says."""
    labelled = scoring._filled(churn_rows(spark, 80))
    model = scoring.fit_risk_model(labelled)
    scored = model.probability(labelled)
    scored.explain(True)
    assert "UDF" not in capsys.readouterr().out
    own = model.classifier.transform(scoring._assembled(labelled, model.scaling)).select("ClientKey", "probability").collect()
    wanted = {r["ClientKey"]: r["probability"][1] for r in own}
    got = {r["ClientKey"]: r["Probability"] for r in scored.collect()}
    assert got == pytest.approx(wanted, rel=1e-12) and scored.columns == [*labelled.columns, "Probability"]


def test_single_class_gives_a_constant_score(spark):
    result = scoring.score_risk(churn_rows(spark).withColumn("DaysSinceLastRequest", F.lit(1)))
    assert {r["ChurnRiskScore"] for r in result.scores.collect()} == {0.0}
    rows = result.evaluation.collect()
    assert rows[0]["Model"] == "Constant baseline model" and rows[0]["ROCAUC"] is None and rows[0]["Recall"] == 0
    assert rows[0]["Validation"] == scoring.NO_HOLDOUT_NOTE and result.thresholds is None


def test_risk_evaluation_tables(spark):
    result = scoring.score_risk(churn_rows(spark, 200))
    rows = {r["Model"]: r for r in result.evaluation.collect()}
    assert rows["Proxy rule baseline"]["F1"] == 1.0 and rows["Proxy rule baseline"]["ROCAUC"] == 1.0
    assert rows["Logistic regression"]["Validation"] == scoring.HOLDOUT_NOTE
    assert result.thresholds.count() == 9 and result.confusion.count() == 4 and result.coefficients.count() == 7
    assert result.class_balance.first()["PositiveCount"] == 100


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])


def brute_ap(y, s):
    out, seen = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = (s >= t) & (y == 1)
        recall = hit.sum() / (y == 1).sum()
        out, seen = out + (recall - seen) * hit.sum() / (s >= t).sum(), recall
    return out


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_areas_match_brute_force(spark, partitions):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 800)
    s = np.where(rng.random(800) < 0.34, 0.5, np.round(rng.random(800) * 0.7 + 0.3 * y, 2))
    df = spark.createDataFrame(list(zip(y.tolist(), s.tolist())), "y int, s double").repartition(partitions)
    assert evaluate.roc_auc(df, "y", "s").first()[0] == pytest.approx(brute_auc(y, s))
    assert evaluate.average_precision(df, "y", "s").first()[0] == pytest.approx(brute_ap(y, s))
    only = df.where("y = 1")
    assert evaluate.roc_auc(only, "y", "s").first()[0] is None and evaluate.average_precision(only, "y", "s").first()[0] is None


def test_holdout_takes_an_exact_share_of_each_class(spark):
    df = spark.range(4001).withColumn("y", (F.col("id") % 20 == 0).cast("int")).union(spark.createDataFrame([(-1, 2), (-2, 2)], "id bigint, y int"))
    drawn = evaluate.with_holdout(df, "id", "y").groupBy("y").agg(F.count_if("IsHoldout"), F.count("y")).collect()
    assert {tuple(r) for r in drawn} == {(0, 950, 3800), (1, 51, 201), (2, 1, 2)}
    again = evaluate.with_holdout(df.repartition(7), "id", "y").where("IsHoldout").select("id")
    assert again.exceptAll(evaluate.with_holdout(df, "id", "y").where("IsHoldout").select("id")).count() == 0
    assert evaluate.with_holdout(df, "id", share=0.2).where("IsHoldout").count() == 801


def test_regression_metrics_of_constant_target(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 6.0)], "y double, p double")
    row = evaluate.regression_metrics(df, "m", "y", "p").first()
    assert (row["MAE"], row["R2"], row["PredictionRangeValid"]) == (2.0, None, False)


def satisfaction_rows(spark, rows=60):
    data = [(k, 1 + k % 3, 1 + k % 2, 1 + k % 2, 1 + k % 2, ["Chat", "Completion"][k % 2], 100 + k, 200.0 + k if k % 7 else None,
             0.01 * k, 1, k % 24, k % 2 == 0, [1.5, 2.5, 3.5, 4.5, 5.0][k % 5] if k % 4 else None, k % 5) for k in range(rows)]
    return spark.createDataFrame(data, "UsageID int, ModelKey int, FeatureKey int, RegionKey int, SubscriptionTierKey int, RequestType string, "
                                 "TotalTokens int, LatencyMs double, CostUSD double, SuccessFlag int, HourOfDay int, IsWeekend boolean, "
                                 "SatisfactionScore double, ClientKey int")


def test_satisfaction_is_bounded_and_audited(spark):
    result = scoring.score_satisfaction(satisfaction_rows(spark), trees=10, max_depth=5, folds=2)
    scored = result.scored.collect()
    assert len(scored) == 60 and all(1 <= r["SatisfactionPredicted"] <= 5 for r in scored)
    assert {r["SatisfactionPredictionPopulation"] for r in scored} == {"Observed score available", "Previously unrated request"}
    kinds = {(r["EvaluationType"], r["Model"]): r for r in result.evaluation().collect()}
    forest = kinds["holdout_model_comparison", "Random forest regressor"]
    assert forest["RMSE"] > 0 and forest["CV_RMSE"] > 0 and forest["PredictionRangeValid"]
    assert kinds["holdout_model_comparison", "Training-mean baseline"]["CV_RMSE"] is None
    populations = [(r["Group"], r["SampleSize"]) for r in result.evaluation(result.scored).where("GroupDimension = 'Population'").collect()]
    assert sorted(populations) == [("Observed satisfaction scores", 45), ("Predictions for previously unrated requests", 15)]
    overall = result.coverage.where("Dimension = 'Overall'").first()
    assert (overall["TotalRequests"], overall["LabeledRequests"]) == (60, 45)


def test_too_few_ratings_are_rejected(spark):
    with pytest.raises(ValueError, match="at least 10 rated"):
        scoring.score_satisfaction(satisfaction_rows(spark, 12), trees=2, folds=0)


def test_unseen_category_is_scored(spark):
    rated = satisfaction_rows(spark).where("SatisfactionScore IS NOT NULL")
    model = scoring.fit_satisfaction(rated, trees=3, max_depth=3)
    new = satisfaction_rows(spark).limit(1).withColumn("ModelKey", F.lit(77)).withColumn("RequestType", F.lit(None).cast("string"))
    assert scoring.predict_satisfaction(model, new).first()["SatisfactionPredicted"] is not None


def test_satisfaction_fills_with_exact_medians_and_frequent_labels(spark):
    rated = satisfaction_rows(spark, 400).where("SatisfactionScore IS NOT NULL").withColumn(
        "ModelKey", F.when(F.col("UsageID") % 5 > 0, F.col("ModelKey")))
    model = scoring.fit_satisfaction(rated, trees=2, max_depth=2)
    pdf = rated.toPandas()
    assert model.medians["LatencyMs"] == pdf.LatencyMs.median() and model.medians["TotalTokens"] == pdf.TotalTokens.median()
    counts = pdf.ModelKey.dropna().astype(int).astype(str).value_counts()
    expected = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    found = model.label_table().where("Column = 'ModelKey'").orderBy("Index").collect()
    assert [(r["Label"], r["Index"]) for r in found] == [(k, float(i)) for i, (k, _) in enumerate(expected)]
    gaps = scoring._encoded(rated.withColumn("RequestType", F.lit("new")), model.medians, model.labels)
    assert gaps.count() == rated.count() and gaps.where("_x_RequestType <> 2").count() == 0
    assert gaps.where("ModelKey IS NULL AND _x_ModelKey <> 0").count() == 0


def test_registered_satisfaction_is_the_whole_job(spark, monkeypatch):
    from checks.registered import QUERIES

    asked = []

    def fit(rated, trees=250, max_depth=None, key="UsageID", real=scoring.fit_satisfaction):
        asked.append((trees, max_depth, rated.count()))
        return real(rated, 2, 2)

    monkeypatch.setattr(scoring, "fit_satisfaction", fit)
    scored = QUERIES["ml17_satisfaction_scores"](spark, "/root/testdata/sf0.001")
    rated, rows = scored.where("SatisfactionScore IS NOT NULL").count(), scored.count()
    assert rows > rated and scored.where("SatisfactionPredicted IS NULL").count() == 0
    assert len(asked) == 1 and QUERIES["ml18_satisfaction_evaluation"](spark, "/root/testdata/sf0.001").count() > 3
    assert len(asked) == 7 and all(a[:2] == (250, None) for a in asked)
    assert asked[0][2] == asked[1][2] == rated - math.ceil(rated * 0.2) and sum(a[2] for a in asked[2:]) == 4 * rated


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    """Two fits wait for each other, which ends only if both run; errors are those of folds fitted one by one."""
    rated = satisfaction_rows(spark).where("SatisfactionScore IS NOT NULL").cache()
    monkeypatch.setattr(scoring, "FOLDS_AT_ONCE", 1, raising=False)
    alone = scoring.cross_validated_rmse(rated, "UsageID", 4, 3, 3)
    met = threading.Barrier(2, timeout=60)

    def fit(*args, real=scoring.fit_satisfaction):
        met.wait()
        return real(*args)

    monkeypatch.setattr(scoring, "fit_satisfaction", fit)
    monkeypatch.setattr(scoring, "FOLDS_AT_ONCE", 2, raising=False)
    assert scoring.cross_validated_rmse(rated, "UsageID", 4, 3, 3) == alone
    rated.unpersist()


def anomaly_rows(spark, rows=4000):
    df = spark.range(rows).select(
        F.col("id").alias("UsageID"), (1 + F.col("id") * 7919 % 101 / 100).alias("CostUSD"),
        (100 + F.col("id") * 104729 % 97).alias("TotalTokens"), (200 + F.col("id") * 1299709 % 89).cast("double").alias("LatencyMs"),
    )
    far = F.col("UsageID") % 400 == 5
    return df.withColumns({"CostUSD": F.when(far, 50.0).otherwise(F.col("CostUSD")), "LatencyMs": F.when(far, 9000.0).otherwise(F.col("LatencyMs"))})


@pytest.mark.parametrize("rows", [30, 4000, 30_000])
def test_isolation_flags_the_planted_rows(spark, rows):
    scored, summary = detect_anomalies(anomaly_rows(spark, rows))
    flagged = scored.where("IsAnomaly").count()
    assert 0 < flagged <= rows * 0.02 + 1
    if rows > 30:
        assert scored.where("UsageID % 400 = 5 AND NOT IsAnomaly").count() == 0
    counts = {r["Pattern"]: r["Count"] for r in summary.collect()}
    assert counts["Total scored requests"] == rows and counts["Statistical anomaly"] == flagged
    assert counts["Both statistical anomaly and rule-based outlier"] + counts["Statistical anomaly only"] == flagged


def test_isolation_does_not_depend_on_partitioning(spark):
    a = isolation.statistical_anomalies(anomaly_rows(spark)).orderBy("UsageID").collect()
    b = isolation.statistical_anomalies(anomaly_rows(spark).repartition(11)).orderBy("UsageID").collect()
    assert a == b


def test_row_with_missing_feature_has_no_score(spark):
    df = anomaly_rows(spark, 300).withColumn("CostUSD", F.when(F.col("UsageID") != 3, F.col("CostUSD")))
    row = isolation.statistical_anomalies(df).where("UsageID = 3").first()
    assert row["StatisticalAnomalyScore"] is None and not row["IsStatisticalAnomaly"]


def test_average_path_of_small_trees():
    np.testing.assert_allclose(isolation.average_path(np.array([1, 2, 256])), [0, 1, 10.2448], atol=1e-3)


def test_whole_run(spark, usage_star, tmp_path):
    out = str(tmp_path / "out")
    master = build_master(usage_star, out)
    assert master.count() == 3000
    scored = run_scoring(spark, out, trees=5, max_depth=4, folds=2)
    assert scored.count() == 3000
    assert {"ChurnRiskScore", "SatisfactionPredicted", "IsAnomaly", "AnomalyScore", "RuleOutlier_CostUSD"} <= set(scored.columns)
    future = run_forecasting(spark, out)
    assert future.count() == 90
    tables = Catalog(spark, out).load_dashboard()
    assert tables["data quality report"].first()["critical_failure"] is False
    assert tables["cost forecast"].count() == 30 and tables["anomaly summary"].count() >= 10
    per_region = run_forecasting(spark, out, keys=["FeatureName"])
    assert per_region.select("FeatureName").distinct().count() == 3


def test_label_coverage_reads_its_rows_once(spark, capsys):
    rows = [(1 + k % 2, k % 3, 1, None if k == 4 else k % 2, "A", float(k) if k % 4 else None) for k in range(12)]
    df = spark.createDataFrame(rows, "ModelKey int, ClientKey int, RegionKey int, FeatureKey int, RequestType string, SatisfactionScore double")
    covered = evaluate.label_coverage(df)
    covered.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    found = {(r["Dimension"], r["Group"]): tuple(r)[2:] for r in covered.collect()}
    scores = [r[5] for r in rows if r[5] is not None]
    assert found["Overall", "All requests"] == found["RequestType", "A"] == (12, 9, 3, 75.0, sum(scores) / 9)
    assert found["FeatureKey", "nan"] == (1, 0, 1, 0.0, None)
    assert [tuple(r) for r in evaluate.label_coverage(df.limit(0)).collect()] == [("Overall", "All requests", 0, 0, 0, None, None)]
