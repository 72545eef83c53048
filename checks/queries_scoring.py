"""Registered: client features, evaluation, risk, satisfaction and anomaly signals."""

from pyspark.sql import functions as F

from checks.registry import item_parts, register, requested, rounded, shipped
from meterstar.functions import columns as C
from meterstar.operators import enrich, evaluate, features, isolation, scoring
from meterstar.operators.ranking import tukey_fences
from meterstar.session import materialise
from meterstar.sources import samples


def with_quota(spark, sf_dir):
    """Usage rows with the month's utilisation, stored as the master is."""
    usage = enrich.month_tokens(shipped(spark, sf_dir, "feature", "subscription").select(
        "ClientKey", "Date", "Month", "CostUSD", "SatisfactionScore", "SuccessFlag", "IsPremium", "TotalTokens",
        "MonthlyQuotaTokens",
    ), item_parts(spark, sf_dir))
    used = C.ratio("MonthlyTokensUsed", "MonthlyQuotaTokens") * 100.0
    return materialise(usage.withColumn("QuotaUtilizationPct", used).drop("MonthlyTokensUsed", "TotalTokens"))


def client_features(spark, sf_dir):
    return features.churn_features(with_quota(spark, sf_dir))


def judged_items(spark, sf_dir):
    """A label and a score that SQL can repeat, per line item."""
    return samples.fact_table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("Actual"),
        (F.col("l_quantity") / 100 + F.col("l_linenumber") / 20).alias("Score"),
    ).withColumn("Predicted", (F.col("Score") >= 0.5).cast("int"))


def judged_satisfaction(spark, sf_dir):
    """Satisfaction with a formula prediction, per usage row."""
    return shipped(spark, sf_dir, "region").withColumn("Prediction", 1 + F.sqrt("TokensInput") / 2)


@register("ml1_client_features")
def _(spark, sf_dir):
    return rounded(client_features(spark, sf_dir), SatisfactionTrend=9)


@register("ml3_proxy_label")
def _(spark, sf_dir):
    return client_features(spark, sf_dir).select("ClientKey", features.proxy_label().alias("ChurnSignal"))


@register("ml4_class_balance")
def _(spark, sf_dir):
    return rounded(evaluate.class_balance(judged_items(spark, sf_dir), "Actual"))


@register("ml5_stratified_holdout")
def _(spark, sf_dir):
    items = samples.fact_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    flagged = evaluate.with_holdout(items, "o_orderkey", "o_orderstatus")
    return flagged.groupBy("o_orderstatus").agg(F.count_if("IsHoldout").alias("Holdout"), F.count(F.lit(1)).alias("Total"))


@register("ml6_risk_scores")
def _(spark, sf_dir):
    return scoring.score_risk(risk_input(spark, sf_dir)).scores


@register("ml6_risk_evaluation")
def _(spark, sf_dir):
    return scoring.score_risk(risk_input(spark, sf_dir)).evaluation


def risk_input(spark, sf_dir):
    """Client features with quotas large enough that the proxy finds both classes."""
    return client_features(spark, sf_dir).withColumn("QuotaUtilizationPct", F.col("QuotaUtilizationPct") / 10)


@register("ml15_coefficients")
def _(spark, sf_dir):
    return scoring.score_risk(risk_input(spark, sf_dir)).coefficients


@register("ml9_classification_metrics")
def _(spark, sf_dir):
    return rounded(evaluate.classification_metrics(judged_items(spark, sf_dir), "Formula", "Actual", "Predicted"))


@register("ml10_roc_auc")
def _(spark, sf_dir):
    return rounded(evaluate.roc_auc(judged_items(spark, sf_dir), "Actual", "Score"))


@register("ml11_average_precision")
def _(spark, sf_dir):
    return rounded(evaluate.average_precision(judged_items(spark, sf_dir), "Actual", "Score"))


@register("ml13_confusion_matrix")
def _(spark, sf_dir):
    return evaluate.confusion_matrix(judged_items(spark, sf_dir), "Actual", "Predicted")


@register("ml14_threshold_sweep")
def _(spark, sf_dir):
    return rounded(evaluate.threshold_sweep(judged_items(spark, sf_dir), "Actual", "Score"))


def satisfaction(spark, sf_dir, folds=5):
    """The whole satisfaction job, with its defaults: 250 trees, holdout and five folds. Scores don't depend on the folds."""
    return scoring.score_satisfaction(requested(spark, sf_dir).withColumns({
        "HourOfDay": F.floor(F.col("TimeKey") / 100), "IsWeekend": C.is_weekend("Date"),
    }), folds=folds)


@register("ml17_satisfaction_scores")
def _(spark, sf_dir):
    return satisfaction(spark, sf_dir, folds=0).scored.select("UsageID", "SatisfactionScore", "SatisfactionPredicted")


@register("ml18_satisfaction_evaluation")
def _(spark, sf_dir):
    return rounded(satisfaction(spark, sf_dir).evaluation())


@register("ml19_regression_metrics")
def _(spark, sf_dir):
    rated = judged_satisfaction(spark, sf_dir).where("SatisfactionScore IS NOT NULL")
    return rounded(evaluate.regression_metrics(rated, "Formula", "SatisfactionScore", "Prediction"))


@register("ml19_group_metrics")
def _(spark, sf_dir):
    rated = judged_satisfaction(spark, sf_dir).where("SatisfactionScore IS NOT NULL")
    return rounded(evaluate.group_metrics(rated, "Formula", "SatisfactionScore", "Prediction"))


@register("ml19b_population_summary")
def _(spark, sf_dir):
    return evaluate.population_summary(judged_satisfaction(spark, sf_dir), "SatisfactionScore", "Prediction")


@register("ml19c_label_coverage")
def _(spark, sf_dir):
    return rounded(evaluate.label_coverage(shipped(spark, sf_dir, "region")))


@register("ml20_tukey_fences")
def _(spark, sf_dir):
    stored = materialise(shipped(spark, sf_dir).select(*scoring.ANOMALY_FEATURES))
    fences = tukey_fences(stored, scoring.ANOMALY_FEATURES)
    return rounded(spark.createDataFrame(list(fences.items()), "Feature string, UpperFence double"))


@register("ml21_rule_outliers")
def _(spark, sf_dir):
    flagged, _ = scoring.rule_outliers(requested(spark, sf_dir))
    return flagged.select("UsageID", *[f"RuleOutlier_{c}" for c in scoring.ANOMALY_FEATURES], "IsRuleBasedOutlier")


@register("ml22_isolation_forest")
def _(spark, sf_dir):
    scored = isolation.statistical_anomalies(requested(spark, sf_dir))
    return scored.select("UsageID", "IsStatisticalAnomaly", "StatisticalAnomalyScore")


@register("ml23_anomaly_summary")
def _(spark, sf_dir):
    # The statistical flag is a formula here, so that SQL can repeat the summary.
    usage = shipped(spark, sf_dir).withColumn("IsStatisticalAnomaly", F.col("CostUSD") > 95000)
    stored = materialise(usage.select(*scoring.ANOMALY_FEATURES, "IsStatisticalAnomaly"))
    flagged, fences = scoring.rule_outliers(stored)
    return rounded(scoring.anomaly_summary(flagged, fences))
