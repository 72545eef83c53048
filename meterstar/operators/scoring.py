"""Disengagement risk, satisfaction prediction and anomaly signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators import evaluate as E
from meterstar.operators.features import CHURN_FEATURES, proxy_label
from meterstar.operators.forest import LEAST_LEAF, Forest, fit_forest, predict_forest
from meterstar.operators.ranking import quantiles, row_index, tukey_fences
from meterstar.session import materialise, ship_package

# --- disengagement risk -----------------------------------------------------------

# Notes on how the holdout was drawn.
HOLDOUT_NOTE = "A quarter of each class was held out; scaling and fitting saw the other rows."
NO_HOLDOUT_NOTE = "Holdout unavailable: fewer than two observations in one class."


@dataclass
class RiskModel:
    """A fitted risk model: scaling figures and either a logistic model or a constant class."""

    scaling: dict[str, tuple[float, float]]
    classifier: Transformer | None
    constant: int | None

    def probability(self, df: DataFrame, name: str = "Probability") -> DataFrame:
        """Add the probability of the positive class."""
        if self.classifier is None:
            return df.withColumn(name, F.lit(float(self.constant)))
        # Plain arithmetic: the model's own transform runs functions whose encoders Spark at times cannot send to its tasks.
        weights = [v for _, v in self.coefficients()]
        margin = reduce(lambda a, b: a + b, [z * F.lit(v) for z, v in zip(_standardised(self.scaling).values(), weights)])
        margin = margin + F.lit(float(self.classifier.intercept))
        return df.withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))

    def coefficients(self) -> list[tuple[str, float]]:
        if self.classifier is None:
            return []
        return [(n, float(v)) for n, v in zip(CHURN_FEATURES, self.classifier.coefficients)]


def _filled(features: DataFrame) -> DataFrame:
    """Features as doubles with missing ones 0, and the proxy label."""
    labelled = features.withColumn("ChurnSignal", proxy_label())
    numbers = {c: F.coalesce(C.as_double(c), F.lit(0.0)) for c in CHURN_FEATURES}
    return labelled.withColumn("ChurnSignal", F.coalesce("ChurnSignal", F.lit(0))).withColumns(numbers)


def _scaling(df: DataFrame) -> dict[str, tuple[float, float]]:
    figures = df.agg(*[f(c).alias(f"{n}_{c}") for c in CHURN_FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    # A constant feature is centred but not divided.
    return {c: (figures[f"m_{c}"], figures[f"s_{c}"] or 1.0) for c in CHURN_FEATURES}


def _standardised(scaling: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    return {f"_z_{c}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaling.items()}


def _assembled(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    scaled = _standardised(scaling)
    return VectorAssembler(inputCols=list(scaled), outputCol="_features").transform(df.withColumns(scaled))


def fit_risk_model(labelled: DataFrame) -> RiskModel:
    """Standardised L2 logistic regression (unit penalty on the summed loss), or the only class."""
    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("ChurnSignal").alias("pos")).first()
    if counts["pos"] in (0, counts["n"]):
        return RiskModel({}, None, int(counts["pos"] > 0))
    scaling = _scaling(labelled)
    learner = LogisticRegression(
        featuresCol="_features", labelCol="ChurnSignal", maxIter=2000, tol=1e-8,
        regParam=1.0 / counts["n"], elasticNetParam=0.0, standardization=False,
    )
    return RiskModel(scaling, learner.fit(_assembled(labelled, scaling)), None)


@dataclass
class RiskResult:
    """Scores per client and the evaluation tables."""

    scores: DataFrame
    model: RiskModel
    class_balance: DataFrame
    evaluation: DataFrame
    confusion: DataFrame
    thresholds: DataFrame | None
    coefficients: DataFrame | None


def score_risk(features: DataFrame) -> RiskResult:
    """Risk score 0..100 per client from the proxy label, evaluated on a stratified holdout."""
    labelled = materialise(_filled(features))
    balance = E.class_balance(labelled, "ChurnSignal")
    counts = balance.first()
    held_out = min(counts["PositiveCount"], counts["NegativeCount"]) >= 2
    train = holdout = labelled
    if held_out:
        parted = materialise(E.with_holdout(labelled, "ClientKey", "ChurnSignal"))
        train, holdout = parted.where("NOT IsHoldout"), parted.where("IsHoldout")
    trained = fit_risk_model(train)
    judged = trained.probability(holdout).withColumns({
        "Predicted": (F.col("Probability") > 0.5).cast("int"), "Baseline": proxy_label(),
    })
    judged = materialise(judged)
    two_classes = trained.classifier is not None
    name = "Logistic regression" if two_classes else "Constant baseline model"
    none = F.lit(None).cast("double")

    def row(label: str, predicted: str, score: str | None) -> DataFrame:
        metrics = E.classification_metrics(judged, label, "ChurnSignal", predicted)
        if score is None:
            return metrics.withColumns({"ROCAUC": none, "PRAUC": none})
        return metrics.withColumns({
            "ROCAUC": E.roc_auc(judged, "ChurnSignal", score).scalar(),
            "PRAUC": E.average_precision(judged, "ChurnSignal", score).scalar(),
        })

    evaluation = row(name, "Predicted", "Probability" if two_classes else None).unionByName(
        row("Proxy rule baseline", "Baseline", "Baseline")
    ).withColumn("Validation", F.lit(HOLDOUT_NOTE if held_out else NO_HOLDOUT_NOTE))
    final = fit_risk_model(labelled)
    risk = F.bround(C.clip(F.col("Probability") * 100, 0.0, 100.0), 2)
    spark = features.sparkSession
    return RiskResult(
        scores=final.probability(labelled).select("ClientKey", risk.alias("ChurnRiskScore")),
        model=final,
        class_balance=balance,
        evaluation=evaluation,
        confusion=E.confusion_matrix(judged, "ChurnSignal", "Predicted"),
        thresholds=E.threshold_sweep(judged, "ChurnSignal", "Probability") if two_classes else None,
        coefficients=E.coefficient_table(final.coefficients(), spark) if two_classes else None,
    )


# --- satisfaction -----------------------------------------------------------------

# Inputs of the satisfaction model and range of the scores.
CATEGORICAL = ("ModelKey", "FeatureKey", "RegionKey", "SubscriptionTierKey", "RequestType")
NUMERIC = ("TotalTokens", "LatencyMs", "CostUSD", "SuccessFlag", "HourOfDay", "IsWeekend")
SATISFACTION_FEATURES = (*CATEGORICAL, *NUMERIC)
SCORE_RANGE = (1.0, 5.0)
LEAST_RATED = 10
FOLDS_AT_ONCE = 3
FOREST = "Random forest regressor"


def _typed_features(df: DataFrame) -> DataFrame:
    texts = {f"_c_{c}": F.col(c).cast("string") for c in CATEGORICAL}
    numbers = {f"_n_{c}": F.col(c).cast("int").cast("double") if c == "IsWeekend" else C.as_double(c) for c in NUMERIC}
    return df.withColumns({**texts, **numbers})


@dataclass
class SatisfactionModel:
    """A fitted satisfaction model: medians, labels numbered by frequency (with their number), and forest."""

    medians: dict[str, float]
    labels: dict[str, tuple[DataFrame, int]]
    forest: Forest

    def label_table(self) -> DataFrame:
        """``Column, Label, Index`` of all categorical columns; the label with index 0 stands in for missing ones."""
        return reduce(DataFrame.unionByName, [
            table.select(F.lit(c).alias("Column"), F.col("_label").alias("Label"), F.col("_index").alias("Index"))
            for c, (table, _) in self.labels.items()
        ])


def _numbered_labels(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[DataFrame, int]]:
    """Per column ``_label, _index``: the most frequent label has index 0, equals go in text order; and the number of labels.

    All columns are counted in one pass and numbered by one sort; no label reaches the driver.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(c).alias("_label")) for i, c in enumerate(columns)])
    counts = df.select(F.explode(cells).alias("c")).select("c.*").where("_label IS NOT NULL").groupBy("_column", "_label").agg(F.count(F.lit(1)).alias("_n"))
    numbered = materialise(row_index(counts, [F.col("_column"), F.desc("_n"), F.col("_label")], "_place"))
    first = {r["_column"]: (r["first"], r["n"]) for r in numbered.groupBy("_column").agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for i, c in enumerate(columns):
        start, size = first.get(i, (0, 0))
        table = numbered.where(F.col("_column") == i).select("_label", (F.col("_place") - start).cast("double").alias("_index"))
        out[c] = table, size
    return out


def _encoded(df: DataFrame, medians: Mapping[str, float], labels: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Filled numbers and label numbers, and both as ``_x``; a missing label becomes the most frequent one, an unseen one comes after all others."""
    out = _typed_features(df).withColumns({
        f"_i_{c}": F.coalesce(F.when(~F.isnan(f"_n_{c}"), F.col(f"_n_{c}")), F.lit(medians[c])) for c in NUMERIC
    })
    for c, (table, size) in labels.items():
        numbered = table.select(F.col("_label").alias(f"_l_{c}"), F.col("_index").alias(f"_k_{c}"))
        out = out.join(numbered, F.col(f"_c_{c}") == F.col(f"_l_{c}"), "left")
        index = F.coalesce(F.col(f"_k_{c}"), F.lit(float(size)))
        out = out.withColumn(f"_x_{c}", F.when(F.col(f"_c_{c}").isNull(), F.lit(0.0)).otherwise(index))
    return out.withColumn("_x", F.array(*[F.col(f"_i_{c}") for c in NUMERIC], *[F.col(f"_x_{c}") for c in CATEGORICAL]))


def fit_satisfaction(rated: DataFrame, trees: int = 250, max_depth: int | None = None, key: str = "UsageID") -> SatisfactionModel:
    """Fit on rated rows, with exact medians and the most frequent labels in place of missing values.

    Each label is split off against all others, and every boundary between numbers is tried.
    """
    typed = _typed_features(rated)
    found = quantiles(typed, {f"_n_{c}": (0.5,) for c in NUMERIC})
    medians = {c: found[f"_n_{c}"][0.5] or 0.0 for c in NUMERIC}  # a column without values is constant
    labels = dict(zip(CATEGORICAL, _numbered_labels(typed, [f"_c_{c}" for c in CATEGORICAL]).values()))
    rows = _encoded(rated, medians, labels).select(key, F.col("SatisfactionScore").cast("double").alias("y"), F.col("_x").alias("x"))
    return SatisfactionModel(medians, labels, fit_forest(rows, len(NUMERIC), trees, LEAST_LEAF, max_depth, key))


def predict_satisfaction(model: SatisfactionModel, df: DataFrame, name: str = "SatisfactionPredicted") -> DataFrame:
    """Add predictions, kept within the score range."""
    scored = predict_forest(model.forest, _encoded(df, model.medians, model.labels), "_x", "_raw")
    return scored.withColumn(name, C.clip("_raw", *SCORE_RANGE)).select(*df.columns, name)


@dataclass
class SatisfactionResult:
    """Scored requests and the evaluation tables."""

    scored: DataFrame
    model: SatisfactionModel
    holdout: DataFrame
    coverage: DataFrame

    def evaluation(self, stored: DataFrame | None = None) -> DataFrame:
        """Holdout errors, and the prediction populations as read from the stored scored rows.

        Without stored rows the predictions are computed again.
        """
        scored = self.scored if stored is None else stored
        populations = E.population_summary(scored, "SatisfactionScore", "SatisfactionPredicted")
        return self.holdout.unionByName(_evaluation_rows(
            populations.withColumn("Model", F.lit(FOREST)), "prediction_population_summary", F.lit("Population"), F.col("Group")
        ))


def _evaluation_rows(df: DataFrame, kind: str, dimension: Column, group: Column, cv: float | None = None) -> DataFrame:
    """Rows of the evaluation table; measures that do not apply are NULL."""
    none = F.lit(None).cast("double")
    measures = [F.col(c) if c in df.columns else none.alias(c) for c in ("MAE", "RMSE", "R2")]
    return df.select(
        F.lit(kind).alias("EvaluationType"), "Model", dimension.alias("GroupDimension"), group.alias("Group"),
        "SampleSize", *measures, F.lit(cv).cast("double").alias("CV_RMSE"), "PredictionRangeValid",
    )


def cross_validated_rmse(rated: DataFrame, key: str, folds: int = 5, trees: int = 250, max_depth: int | None = None) -> float:
    """Mean of the folds' RMSE; folds are drawn by key hash. Some are fitted side by side, so that small jobs of one run beside trees of another."""
    slot = E.hash_slot(key, seed=E.SEED + 1, slots=folds)

    def error(fold: int) -> float | None:
        model = fit_satisfaction(rated.where(slot != fold), trees, max_depth, key)
        judged = predict_satisfaction(model, rated.where(slot == fold), "_predicted")
        squared = (F.col("_predicted") - F.col("SatisfactionScore")) ** 2
        return judged.agg(F.sqrt(F.avg(squared))).first()[0]

    ship_package(rated.sparkSession)                                # once, before the folds need it
    with ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(rated.sparkSession)(error), fold) for fold in range(folds)]
        errors = [e for e in (one.result() for one in running) if e is not None]
    return sum(errors) / len(errors)


def score_satisfaction(master: DataFrame, key: str = "UsageID", trees: int = 250, max_depth: int | None = None,
                       folds: int = 5, dimensions: Sequence[str] = E.GROUP_DIMENSIONS) -> SatisfactionResult:
    """Predict satisfaction for all requests; audit on a 20 % holdout of the rated ones."""
    rated = master.where(F.col("SatisfactionScore").isNotNull())
    columns = list(dict.fromkeys([key, "SatisfactionScore", *SATISFACTION_FEATURES, *dimensions]))
    rated = materialise(rated.select(*columns))
    if rated.count() < LEAST_RATED:
        raise ValueError(f"at least {LEAST_RATED} rated requests are required for satisfaction modelling")
    rated = materialise(E.with_holdout(rated, key, share=0.2))
    train = rated.where("NOT IsHoldout")
    model = fit_satisfaction(train, trees, max_depth, key)
    baseline = train.agg(F.avg("SatisfactionScore")).first()[0]
    judged = materialise(
        predict_satisfaction(model, rated.where("IsHoldout")).withColumn("_mean", F.lit(baseline))
    )
    cv_rmse = cross_validated_rmse(rated, key, folds, trees, max_depth) if folds > 1 else None
    overall, rows = F.lit("Overall"), F.lit("Rated holdout")
    comparison = "holdout_model_comparison"
    holdout = reduce(DataFrame.unionByName, [
        _evaluation_rows(E.regression_metrics(judged, "Training-mean baseline", "SatisfactionScore", "_mean"),
                         comparison, overall, rows),
        _evaluation_rows(E.regression_metrics(judged, FOREST, "SatisfactionScore", "SatisfactionPredicted"),
                         comparison, overall, rows, cv_rmse),
        _evaluation_rows(E.group_metrics(judged, FOREST, "SatisfactionScore", "SatisfactionPredicted", dimensions),
                         "holdout_group_performance", F.col("GroupDimension"), F.col("Group")),
    ])
    population = F.when(F.col("SatisfactionScore").isNotNull(), "Observed score available")
    scored = predict_satisfaction(model, master).withColumn(
        "SatisfactionPredictionPopulation", population.otherwise("Previously unrated request")
    )
    return SatisfactionResult(scored, model, holdout, E.label_coverage(master, dimensions=dimensions))


# --- anomalies ------------------------------------------------------------------------

# Anomaly inputs, share flagged, and the notes of the summary.
ANOMALY_FEATURES = ("CostUSD", "TotalTokens", "LatencyMs")
CONTAMINATION = 0.02
SHARE_NOTE = "Configured expected proportion; not a confirmed incident rate."
FENCE_NOTE = "Rule baseline: value > Q3 + 1.5 * IQR."
RULE_NOTE = "Features exceeding their transparent Tukey upper fences."


def rule_outliers(df: DataFrame, fences: Mapping[str, float | None] | None = None,
                  features: Sequence[str] = ANOMALY_FEATURES) -> tuple[DataFrame, dict[str, float | None]]:
    """Flag values above each feature's Tukey upper fence, and rows with any flag."""
    limits = dict(fences) if fences is not None else tukey_fences(df, features)
    flags = {
        f"RuleOutlier_{c}": F.coalesce(C.as_double(c) > F.lit(limits[c]).cast("double"), F.lit(False)) for c in features
    }
    any_flag = reduce(lambda a, b: a | b, [F.col(n) for n in flags])
    return df.withColumns(flags).withColumn("IsRuleBasedOutlier", any_flag), limits


def anomaly_summary(scored: DataFrame, fences: Mapping[str, float | None], contamination: float = CONTAMINATION,
                    features: Sequence[str] = ANOMALY_FEATURES) -> DataFrame:
    """Signal counts, agreement of the signals, counts per fence and flag patterns.

    All come from one small table, the count of each flag combination.
    """
    flags = [f"RuleOutlier_{c}" for c in features]
    groups = materialise(
        scored.groupBy("IsStatisticalAnomaly", "IsRuleBasedOutlier", *flags).agg(F.count(F.lit(1)).alias("n"))
    )
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)))
    statistical, rule = F.col("IsStatisticalAnomaly"), F.col("IsRuleBasedOutlier")
    none = F.lit(None).cast("double")

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    wanted = [
        ("configuration", "Isolation Forest contamination", F.lit(0).cast("bigint"), F.lit(contamination), SHARE_NOTE),
        ("population", "Total scored requests", counted(F.lit(True)), none, ""),
        ("statistical_signal", "Statistical anomaly", counted(statistical), none, ""),
        ("rule_signal", "Rule-based outlier", counted(rule), none, ""),
        ("comparison", "Both statistical anomaly and rule-based outlier", counted(statistical & rule), none, ""),
        ("comparison", "Statistical anomaly only", counted(statistical & ~rule), none, ""),
        ("comparison", "Rule-based outlier only", counted(rule & ~statistical), none, ""),
        *[
            ("rule_pattern", f"{c} above Tukey upper fence", counted(F.col(f"RuleOutlier_{c}")),
             F.lit(fences[c]).cast("double"), FENCE_NOTE)
            for c in features
        ],
    ]
    counts = groups.agg(*[c.alias(f"n{i}") for i, (_, _, c, _, _) in enumerate(wanted)])
    cells = F.array(*[
        F.struct(F.lit(kind).alias("SummaryType"), F.lit(pattern).alias("Pattern"), F.col(f"n{i}").alias("Count"),
                 limit.alias("Threshold"), F.lit(note).alias("Notes"))
        for i, (kind, pattern, _, limit, note) in enumerate(wanted)
    ])
    fixed = counts.select(F.explode(cells).alias("c")).select("c.*")
    pattern = F.concat_ws(" + ", *[F.when(F.col(f"RuleOutlier_{c}"), c) for c in features])
    common = groups.where(rule).groupBy(pattern.alias("Pattern")).agg(F.sum("n").alias("Count")).select(
        F.lit("common_pattern").alias("SummaryType"), "Pattern", "Count", none.alias("Threshold"),
        F.lit(RULE_NOTE).alias("Notes"),
    )
    share = F.coalesce(C.ratio(F.col("Count") * 100.0, total.scalar()), F.lit(0.0))
    return fixed.unionByName(common).select("SummaryType", "Pattern", "Count", share.alias("Percentage"), "Threshold", "Notes")


def with_short_names(scored: DataFrame) -> DataFrame:
    """Add the names the dashboard reads: IsAnomaly and AnomalyScore."""
    return scored.withColumns({
        "IsAnomaly": F.col("IsStatisticalAnomaly"), "AnomalyScore": F.col("StatisticalAnomalyScore"),
    })


def ranked_anomalies(scored: DataFrame, key: str = "UsageID") -> DataFrame:
    """Flagged requests, the most unusual first."""
    return scored.where("IsStatisticalAnomaly").orderBy(F.desc("StatisticalAnomalyScore"), key)
