"""Centroid clustering whose nearest centroids are found by the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.vectors import matrix, whole_vectors
from meterstar.session import materialise, ship_package

AT_ONCE = 1024  # vectors walked together
_FAR = np.iinfo(np.int64).max


def sorted_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension the centroids' values in ascending order, and whose they are."""
    owners = np.argsort(centroids, axis=0, kind="stable").T
    return np.take_along_axis(centroids.T, owners, axis=1), owners


def nearest(x: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row of ``x`` and its squared distance; among equals the smaller number.

    Each dimension's sorted list is walked outward from the vector's value, one
    step in all lists at a time. A centroid met for the first time has its exact
    distance computed. One that no list has shown yet is at least as far away, in
    every dimension, as the last value shown there; once the sum of those squared gaps is
    strictly larger than the best distance, the walk ends.
    """
    values, owners = lists or sorted_lists(centroids)
    dims, k = values.shape
    distance = np.full((len(x), k), _FAR)
    right = np.stack([np.searchsorted(values[d], x[:, d]) for d in range(dims)], axis=1) if dims else np.zeros((len(x), 0), np.int64)
    left = right - 1
    own, walking = np.arange(dims), np.arange(len(x))
    for _ in range(k):
        at, l, r = x[walking], left[walking], right[walking]
        below = np.where(l >= 0, at - values[own, np.maximum(l, 0)], _FAR)
        above = np.where(r < k, values[own, np.minimum(r, k - 1)] - at, _FAR)
        down = below <= above
        shown = owners[own, np.where(down, l, r)]
        left[walking] = l - down
        right[walking] = r + ~down
        met = np.zeros((len(walking), k), bool)
        met[np.arange(len(walking))[:, None], shown] = True
        row, centroid = np.nonzero(met & (distance[walking] == _FAR) if dims else distance[walking] == _FAR)
        gaps = at[row] - centroids[centroid]
        distance[walking[row], centroid] = (gaps * gaps).sum(axis=1)
        frontier = np.minimum(below, above)
        walking = walking[(frontier * frontier).sum(axis=1) <= distance[walking].min(axis=1)]
        if not len(walking):
            break
    found = distance.argmin(axis=1)
    return found, distance[np.arange(len(x)), found]


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:id``; rows without an id come last. At most ``clusters`` vectors."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r[0]) for r in rows.orderBy(drawn.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()]


def _walked(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    lists = sorted_lists(centroids)
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(start, AT_ONCE)
            x = matrix(part.column("vector"), centroids.shape[1])
            yield part, x, *nearest(x, centroids, lists)


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance in _walked(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays.

    A task adds up its own vectors, so the shuffle carries one row per task and centroid, and the driver gets one row per
    centroid.
    """
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, x, cluster, _ in _walked(batches, centroids):
            count += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, x)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used], pa.int64()), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            ["cluster", "rows", "sums"])

    parts = rows.mapInArrow(run, "cluster int, rows bigint, sums array<bigint>")
    totals = parts.groupBy("cluster").agg(
        F.sum("rows").alias("rows"), F.array(*[F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(dims)]).alias("sums"))
    out = centroids.copy()
    for cluster, n, sums in totals.collect():
        out[cluster] = [int(s) // n for s in sums]
    return out


def clustered(df: DataFrame, clusters: int = 16, rounds: int = 3, components: int = 64, scale: int = 64, seed: int = 1,
              key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Vectors become whole numbers (``vectors.whole_vectors`` says which rows
    take no part). The first centroids are drawn by a hash of the id, each round
    assigns every vector to its nearest centroid and moves the centroids, and a
    last pass assigns once more. Distances are squared. Rows that repeat an id
    are vectors of their own; NULL ids take part, but are drawn as centroids
    last; with fewer vectors than clusters there are fewer centroids; an empty
    table gives no rows. The driver holds ``clusters * components`` numbers;
    other columns of the input are not read. Copies of a frequent vector stay where they are: only
    sums are shuffled.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = materialise(whole_vectors(df, scale, components, key, vector))
    centroids = np.array(first_centroids(rows, clusters, seed), np.int64).reshape(-1, components)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    out = materialise(assigned(rows, centroids))
    inertia = {r[0]: r[1] for r in out.groupBy("cluster").agg(F.sum("distance")).collect()}
    total = sum(inertia.values())
    known = [(c, inertia.get(c, 0), total, hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()) for c, own in enumerate(centroids.tolist())]
    about = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return out.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
