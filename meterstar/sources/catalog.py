"""Names of the written tables, and their lookup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from meterstar.sources.star import path_exists

# Artifact name and its folder under the output folder.
ARTIFACTS = {
    "usage data": "processed/fact_with_ml",
    "enriched master": "processed/fact_master",
    "client monthly aggregates": "processed/agg_client_monthly",
    "feature adoption": "processed/agg_feature_adoption",
    "model performance": "processed/agg_model_performance",
    "regional monthly aggregates": "processed/agg_region_monthly",
    "client churn scores": "processed/client_churn_scores",
    "data quality report": "processed/data_quality_report",
    "forecast model comparison": "evaluation/forecast_model_comparison",
    "selected forecast models": "evaluation/selected_forecast_models",
    "anomaly summary": "evaluation/anomaly_summary",
    "satisfaction coverage": "evaluation/satisfaction_coverage",
    "satisfaction evaluation": "evaluation/satisfaction_evaluation",
    "churn evaluation": "evaluation/churn_evaluation",
    "churn class balance": "evaluation/churn_class_balance",
    "churn confusion matrix": "evaluation/churn_confusion_matrix",
    "churn threshold analysis": "evaluation/churn_threshold_analysis",
    "churn feature coefficients": "evaluation/churn_feature_coefficients",
    "cost forecast": "forecasts/forecast_cost",
    "request forecast": "forecasts/forecast_requests",
    "token forecast": "forecasts/forecast_tokens",
    "client dimension": "dimensions/client",
    "model dimension": "dimensions/model",
    "feature dimension": "dimensions/feature",
    "region dimension": "dimensions/region",
    "subscription dimension": "dimensions/subscription",
}
# The tables that the dashboard's measures read.
DASHBOARD = (
    "usage data", "client monthly aggregates", "feature adoption", "model performance",
    "regional monthly aggregates", "client churn scores", "data quality report", "forecast model comparison",
    "anomaly summary", "satisfaction coverage", "cost forecast", "request forecast", "token forecast",
    "client dimension", "model dimension", "feature dimension", "region dimension", "subscription dimension",
)


class ArtifactMissingError(FileNotFoundError):
    """A named table has not been written yet."""


@dataclass(frozen=True)
class Catalog:
    """Tables under one output folder, by artifact name."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        if name not in ARTIFACTS:
            raise KeyError(f"unknown artifact: {name}")
        return f"{self.folder.rstrip('/')}/{ARTIFACTS[name]}"

    def require(self, name: str) -> str:
        path = self.path(name)
        if not path_exists(self.spark, path):
            raise ArtifactMissingError(
                f"the {name} artifact is missing: {path}; run the data, scoring and forecasting jobs first"
            )
        return path

    def load(self, name: str) -> DataFrame:
        path = self.require(name)
        return self.spark.read.json(path) if name == "data quality report" else self.spark.read.parquet(path)

    def load_dashboard(self) -> dict[str, DataFrame]:
        """Every dashboard table; all must exist before any is read."""
        for name in DASHBOARD:
            self.require(name)
        return {name: self.load(name) for name in DASHBOARD}
