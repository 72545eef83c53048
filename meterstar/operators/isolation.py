"""Isolation forest: trees grown from small hash samples, scoring where the rows are.

The forest is bounded (trees x at most 2*sample nodes) and travels to the
rows; the rows are never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.operators.evaluate import SEED
from meterstar.operators.ranking import quantiles
from meterstar.operators.scoring import ANOMALY_FEATURES, CONTAMINATION
from meterstar.session import materialise, ship_package

TREES, SAMPLE = 100, 256
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, tree: int, seed: int) -> list[tuple]:
    """Nodes of one tree: random feature, random cut, down to the mean depth."""
    rng = np.random.default_rng((seed, tree))
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes, work = [], [(0, np.arange(len(points)), 0)]
    next_id = 1
    while work:
        node, rows, depth = work.pop()
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes.append((tree, node, -1, 0.0, node, node, depth + float(average_path(len(rows)))))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = points[rows, feature] <= cut
        nodes.append((tree, node, feature, cut, next_id, next_id + 1, 0.0))
        work += [(next_id, rows[goes_left], depth + 1), (next_id + 1, rows[~goes_left], depth + 1)]
        next_id += 2
    return nodes


@dataclass(frozen=True)
class Forest:
    """Trees as arrays indexed (tree, node)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    sample: int
    columns: tuple[str, ...]

    def score(self, points: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1), higher for rows that are isolated sooner."""
        depth = np.zeros(len(points))
        levels = math.ceil(math.log2(max(self.sample, 2)))
        every = np.arange(len(points))
        for t in range(len(self.feature)):
            node = np.zeros(len(points), dtype=np.int32)
            for _ in range(levels):
                f = self.feature[t][node]
                value = points[every, np.maximum(f, 0)]
                node = np.where(value <= self.threshold[t][node], self.left[t][node], self.right[t][node])
            depth += self.path[t][node]
        return np.exp2(-depth / len(self.feature) / float(average_path(self.sample)))


def fit_forest(df: DataFrame, key: str = "UsageID", columns: Sequence[str] = ANOMALY_FEATURES, trees: int = TREES,
               sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """Grow the forest; each tree has the ``sample`` rows with the smallest hashes of (key, tree).

    So the same rows are drawn however the data is partitioned and whatever its
    size. A hash cut that leaves about twice the wanted number comes before
    the rows are multiplied by the trees; it is doubled until every tree has enough. Isolation
    is invariant to scaling a feature, so none is scaled.
    """
    ship_package(df.sparkSession)
    points = df.select(F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    total = points.count()
    if not total:
        raise ValueError("no complete rows to grow a forest from")
    size = min(sample, total)
    draws = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), F.xxhash64(F.col("_key"), t, F.lit(seed)).alias("_hash")))
    share = 2.0 * sample / total
    while True:
        limit = F.lit(min(int(-(2**63) + share * 2**64), 2**63 - 1))
        drawn = points.withColumn("_draw", F.explode(F.filter(draws, lambda d: d["_hash"] <= limit)))
        dealt = materialise(drawn.select("_key", *columns, "_draw.tree", "_draw._hash"))
        counts = dealt.groupBy("tree").count().agg(F.count(F.lit(1)), F.min("count")).first()
        if share >= 1 or (counts[0] == trees and counts[1] >= size):
            break
        share *= 2
    names = list(columns)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = group.sort_values(["_hash", "_key"])[names].to_numpy()[:size]
        return pd.DataFrame(_grow(points, tree, seed), columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])

    nodes = dealt.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    width = int(nodes["node"].max()) + 1

    def table(c: str, dtype, empty) -> np.ndarray:
        out = np.full((trees, width), empty, dtype=dtype)
        out[nodes["tree"], nodes["node"]] = nodes[c]
        return out

    return Forest(table("feature", np.int32, -1), table("threshold", float, 0.0), table("left", np.int32, 0),
                  table("right", np.int32, 0), table("path", float, 0.0), size, tuple(columns))


def score_rows(df: DataFrame, forest: Forest, name: str = "_score") -> DataFrame:
    """Add each row's anomaly score; a row with a missing feature gets NULL."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(forest)  # at most trees * 2 * sample nodes

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            points = np.column_stack([s.to_numpy(dtype=float) for s in batch])
            complete = ~np.isnan(points).any(axis=1)
            out = np.full(len(points), np.nan)
            if complete.any():
                out[complete] = model.score(points[complete])
            yield pd.Series(out)

    value = scored(*[F.col(c).cast("double") for c in forest.columns])
    return df.withColumn(name, value).withColumn(name, F.when(~F.isnan(name), F.col(name)))


def statistical_anomalies(df: DataFrame, key: str = "UsageID", columns: Sequence[str] = ANOMALY_FEATURES,
                          contamination: float = CONTAMINATION, trees: int = TREES, sample: int = SAMPLE,
                          seed: int = SEED, fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``IsStatisticalAnomaly`` and ``StatisticalAnomalyScore`` (above 0 is flagged).

    ``fit_on`` may name a stored table with the same rows, so that growing the
    forest does not compute ``df``. The cut-off is the exact (1 - contamination)
    quantile of the scores; the scored rows are written once, so that finding it
    does not score them again.
    """
    forest = fit_forest(df if fit_on is None else fit_on, key, columns, trees, sample, seed)
    scored = materialise(score_rows(df, forest))
    cut = quantiles(scored, {"_score": (1.0 - contamination,)})["_score"][1.0 - contamination]
    margin = F.col("_score") - F.lit(cut)
    return scored.withColumns({
        "IsStatisticalAnomaly": F.coalesce(margin > 0, F.lit(False)),
        "StatisticalAnomalyScore": margin,
    }).drop("_score")
