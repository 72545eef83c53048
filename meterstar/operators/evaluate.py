"""Evaluation of classifiers and regressors as aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.ranking import ordered_prefix, row_index
from meterstar.session import materialise

HASH_SLOTS = 10_000
SEED = 42
GROUP_DIMENSIONS = ("ModelKey", "ClientKey", "RegionKey", "FeatureKey", "RequestType")


def hash_slot(key: Column | str, seed: int = SEED, slots: int = HASH_SLOTS) -> Column:
    """A pseudo-random slot that depends on the row's key alone, not on its partition."""
    return F.pmod(F.xxhash64(C.col(key), F.lit(seed)), F.lit(slots))


# --- classes and splits --------------------------------------------------------

def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positives, negatives and their shares as one row."""
    positive = F.count_if(F.col(label) == 1)
    rows = F.count(label)
    return df.agg(
        positive.alias("PositiveCount"),
        (rows - positive).alias("NegativeCount"),
        rows.alias("TotalCount"),
        (C.ratio(positive, rows) * 100.0).alias("PositivePct"),
        (C.ratio(rows - positive, rows) * 100.0).alias("NegativePct"),
    )


def with_holdout(df: DataFrame, key: str, label: str | None = None, share: float = 0.25, seed: int = SEED) -> DataFrame:
    """Add ``IsHoldout``: true for exactly ceil(share * rows) rows of each class.

    Each class gives the rows whose unique keys have the smallest hashes, so the draw does not
    depend on the partitions. Their places come from one range sort.
    """
    drawn = df.withColumns({"_class": F.col(label) if label else F.lit(0), "_draw": F.xxhash64(F.lit(seed), F.col(key))})
    placed = row_index(drawn, [F.col("_class").asc_nulls_last(), F.col("_draw"), F.col(key)], "_place")
    classes = materialise(placed.groupBy(F.col("_class").alias("_of")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    joined = placed.join(classes, F.col("_class").eqNullSafe(F.col("_of")))
    held = F.col("_place") - F.col("_first") < F.ceil(F.col("_rows") * F.lit(Decimal(str(share))))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], held.alias("IsHoldout"))


# --- classification ----------------------------------------------------------------

def _rates(actual: Column, predicted: Column) -> dict[str, Column]:
    hits = F.count_if((actual == 1) & (predicted == 1))
    precision = F.coalesce(C.ratio(hits, F.count_if(predicted == 1)), F.lit(0.0))
    recall = F.coalesce(C.ratio(hits, F.count_if(actual == 1)), F.lit(0.0))
    f1 = F.coalesce(C.ratio(2.0 * hits, F.count_if(predicted == 1) + F.count_if(actual == 1)), F.lit(0.0))
    return {"Precision": precision, "Recall": recall, "F1": f1}


def classification_metrics(df: DataFrame, model: str, actual: str, predicted: str) -> DataFrame:
    """Counts, balance, precision, recall and F1 as one row; undefined rates are 0."""
    label, guess = F.col(actual), F.col(predicted)
    return df.agg(
        F.lit(model).alias("Model"),
        F.count_if(label == 1).alias("PositiveCount"),
        F.count_if(label == 0).alias("NegativeCount"),
        (C.mean(actual) * 100.0).alias("ClassBalancePositivePct"),
        *[c.alias(n) for n, c in _rates(label, guess).items()],
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts for all four combinations, also the empty ones."""
    counts = df.agg(*[
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)
    ])
    cells = F.array(*[
        F.struct(F.lit(a).alias("Actual"), F.lit(p).alias("Predicted"), F.col(f"n{a}{p}").alias("Count"))
        for a in (0, 1) for p in (0, 1)
    ])
    return counts.select(F.explode(cells).alias("c")).select("c.*")


def threshold_sweep(df: DataFrame, actual: str, score: str,
                    thresholds: Sequence[float] = tuple(t / 10 for t in range(1, 10))) -> DataFrame:
    """Precision, recall, F1 and positive predictions at each threshold, in one pass."""
    label = F.col(actual)
    columns, cells = [], []
    for i, t in enumerate(thresholds):
        guess = (F.col(score) >= F.lit(t)).cast("int")
        parts = {**_rates(label, guess), "PositivePredictions": F.count_if(guess == 1)}
        columns += [c.alias(f"{n}{i}") for n, c in parts.items()]
        cells.append(F.struct(F.lit(t).alias("Threshold"), *[F.col(f"{n}{i}").alias(n) for n in parts]))
    return df.agg(*columns).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _score_groups(df: DataFrame, actual: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL unless both classes occur.

    Rows combine to one per distinct score; a positive then beats all negatives
    below its score and half of those at it.
    """
    below = ordered_prefix(_score_groups(df, actual, score), [F.asc("s")], {"neg_upto": "neg"})
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    return below.agg(C.ratio(wins, C.as_double(F.sum("pos")) * F.sum("neg")).alias("ROCAUC"))


def average_precision(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Area under the precision-recall steps; NULL unless both classes occur."""
    groups = _score_groups(df, actual, score)
    above = ordered_prefix(groups, [F.desc("s")], {"tp": "pos", "fp": "neg"})
    gained = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")).cast("double")))
    both = (F.sum("pos") > 0) & (F.sum("neg") > 0)
    return above.agg(F.when(both, C.ratio(gained, F.sum("pos"))).alias("PRAUC"))


def coefficient_table(df_rows: Sequence[tuple[str, float]], spark) -> DataFrame:
    """Model coefficients, largest magnitude first."""
    table = spark.createDataFrame(list(df_rows), "Feature string, Coefficient double")
    return table.withColumn("AbsoluteCoefficient", F.abs("Coefficient")).orderBy(F.desc("AbsoluteCoefficient"), "Feature")


# --- regression ----------------------------------------------------------------------

def _errors(actual: str, predicted: str, low: float, high: float) -> list[Column]:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    squared = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    varies = F.min(y) < F.max(y)
    return [
        F.count(F.lit(1)).alias("SampleSize"),
        F.avg(F.abs(y - p)).alias("MAE"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("RMSE"),
        F.when(varies, 1.0 - C.ratio(squared, spread)).alias("R2"),
        F.bool_and(p.between(low, high)).alias("PredictionRangeValid"),
    ]


def regression_metrics(df: DataFrame, model: str, actual: str, predicted: str,
                       low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Errors over all rows as one row; R2 is NULL if the target does not vary."""
    return df.agg(F.lit(model).alias("Model"), *_errors(actual, predicted, low, high))


def by_dimension(df: DataFrame, dimensions: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Repeat each row once per dimension as (dimension, group as text); a missing key is the group 'nan'."""
    cells = F.array(*[
        F.struct(F.lit(d).alias(names[0]), F.coalesce(F.col(d).cast("string"), F.lit("nan")).alias(names[1]))
        for d in dimensions
    ])
    return df.select("*", F.explode(cells).alias("_cell")).select("*", "_cell.*").drop("_cell")


def group_metrics(df: DataFrame, model: str, actual: str, predicted: str,
                  dimensions: Sequence[str] = GROUP_DIMENSIONS, at_least: int = 10,
                  low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Errors per group of each dimension that has enough rows.

    The repeated rows are combined before the shuffle, so they cost memory
    bandwidth on the mappers but no network.
    """
    narrow = df.select(*dimensions, actual, predicted)
    return by_dimension(narrow, dimensions, ("GroupDimension", "Group")).groupBy("GroupDimension", "Group").agg(
        F.lit(model).alias("Model"), *_errors(actual, predicted, low, high)
    ).where(F.col("SampleSize") >= at_least)


def label_coverage(df: DataFrame, score: str = "SatisfactionScore",
                   dimensions: Sequence[str] = GROUP_DIMENSIONS) -> DataFrame:
    """Rated and unrated requests per group of each dimension, and overall."""
    narrow = df.select(*dimensions, score)
    sums = [F.count(F.lit(1)).alias("_total"), F.count(score).alias("_rated"), F.sum(C.as_double(score)).alias("_sum")]
    # The rows are read once: every dimension's groups cover them all, so the first one's add up to the overall figures.
    groups = materialise(by_dimension(narrow, dimensions, ("Dimension", "Group")).groupBy("Dimension", "Group").agg(*sums))
    overall = groups.where(F.col("Dimension") == dimensions[0]).agg(
        F.lit("Overall").alias("Dimension"), F.lit("All requests").alias("Group"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_total", "_rated")], F.sum("_sum").alias("_sum"))
    return groups.unionByName(overall).select(
        "Dimension", "Group", F.col("_total").alias("TotalRequests"), F.col("_rated").alias("LabeledRequests"),
        (F.col("_total") - F.col("_rated")).alias("UnlabeledRequests"),
        (C.ratio("_rated", "_total") * 100.0).alias("LabelCoveragePct"), C.ratio("_sum", "_rated").alias("ObservedSatisfactionMean"),
    )


def population_summary(df: DataFrame, observed: str, predicted: str, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Size and range check of the predictions for rated and for unrated requests."""
    in_range = F.col(predicted).between(low, high)
    populations = {
        "Observed satisfaction scores": F.col(observed).isNotNull(),
        "Predictions for previously unrated requests": F.col(observed).isNull(),
    }
    columns, cells = [], []
    for i, (name, member) in enumerate(populations.items()):
        columns += [
            F.count_if(member).alias(f"n{i}"),
            F.coalesce(F.bool_and(F.when(member, in_range)), F.lit(True)).alias(f"ok{i}"),
        ]
        cells.append(F.struct(F.lit(name).alias("Group"), F.col(f"n{i}").alias("SampleSize"),
                              F.col(f"ok{i}").alias("PredictionRangeValid")))
    return df.agg(*columns).select(F.explode(F.array(*cells)).alias("c")).select("c.*")
