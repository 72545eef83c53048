"""Score the master: disengagement risk, satisfaction, anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterstar.operators import scoring
from meterstar.operators.features import churn_features
from meterstar.operators.isolation import statistical_anomalies
from meterstar.sources.catalog import Catalog
from meterstar.sources.sinks import write_by_month, write_table
from meterstar.sources.star import load_master

REQUIRED = {
    *scoring.SATISFACTION_FEATURES, *scoring.ANOMALY_FEATURES, "ClientKey", "Month", "Date", "SatisfactionScore",
    "IsPremium", "QuotaUtilizationPct",
}


def detect_anomalies(master: DataFrame, key: str = "UsageID",
                     contamination: float = scoring.CONTAMINATION,
                     fit_on: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both anomaly signals on every row, and their summary."""
    scored = statistical_anomalies(master, key, contamination=contamination, fit_on=fit_on)
    flagged, fences = scoring.rule_outliers(scored)
    flagged = scoring.with_short_names(flagged)
    return flagged, scoring.anomaly_summary(flagged, fences, contamination)


def run_scoring(spark: SparkSession, out_dir: str, trees: int = 250, max_depth: int | None = None, folds: int = 5) -> DataFrame:
    """Read the written master, score it, write the scored fact, the models and the evaluation tables."""
    catalog = Catalog(spark, out_dir)
    master = load_master(spark, catalog.path("enriched master"), REQUIRED)
    risk = scoring.score_risk(churn_features(master))
    satisfaction = scoring.score_satisfaction(master, trees=trees, max_depth=max_depth, folds=folds)
    write_table(risk.scores, catalog.path("client churn scores"))
    scores = catalog.load("client churn scores")
    joined = satisfaction.scored.join(scores, "ClientKey", "left")
    scored, summary = detect_anomalies(joined, fit_on=master)
    write_by_month(scored, catalog.path("usage data"))
    stored = catalog.load("usage data")
    tables = {
        "anomaly summary": summary,
        "satisfaction evaluation": satisfaction.evaluation(stored),
        "satisfaction coverage": satisfaction.coverage,
        "churn evaluation": risk.evaluation,
        "churn class balance": risk.class_balance,
        "churn confusion matrix": risk.confusion,
        "churn threshold analysis": risk.thresholds,
        "churn feature coefficients": risk.coefficients,
    }
    for name, table in tables.items():
        if table is not None:
            write_table(table, catalog.path(name))
    models = f"{out_dir.rstrip('/')}/models"
    write_table(satisfaction.model.forest.subtrees, f"{models}/satisfaction_trees")
    if satisfaction.model.forest.splits is not None:
        write_table(satisfaction.model.forest.splits, f"{models}/satisfaction_splits")
    write_table(satisfaction.model.label_table(), f"{models}/satisfaction_labels")
    medians = spark.createDataFrame(list(satisfaction.model.medians.items()), "Feature string, Median double")
    write_table(medians, f"{models}/satisfaction_medians")
    if risk.model.classifier is not None:
        risk.model.classifier.write().overwrite().save(f"{models}/churn")
    return stored
