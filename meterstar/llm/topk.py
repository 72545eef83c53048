"""Exact top-k inner products by reading sorted lists, without random access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.llm.vectors import whole_vectors
from meterstar.session import materialise, ship_package

BLOCK_VECTORS = 4096    # candidates whose lists are read together
BATCH_QUERIES = 256     # queries that read them together
DEPTHS = (0.25, 0.5, 0.625, 0.75, 0.875, 1.0)   # share of each list read when the bounds are compared
RESOLVED = 16           # at most one vector in so many is left open when the scores are resolved
_BLOCK = "dims int, block bigint, vectors binary, lists binary, ids array<array<bigint>>"
_LOWEST = np.iinfo(np.int64).min
_FOUND = "dims int, batch bigint, pos int, score bigint, vec_id bigint"


def _exact_type(candidates: np.ndarray, queries: np.ndarray) -> type:
    """The fastest type in which no inner product is rounded."""
    most = candidates.shape[1] * int(np.abs(candidates).max(initial=0)) * int(np.abs(queries).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def read_lists(vectors: np.ndarray, lists: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the rows of ``vectors`` that can be among its k best, with their exact scores.

    ``lists`` has, per dimension, the rows by ascending value; ``least`` is a
    score per query that k others are known to reach. A query reads a list from
    the top where its weight is positive and from the bottom where it is
    negative; all queries share the reading. A row's upper bound takes, for
    what has not been read of it, the last value shown by the list; its lower bound takes the
    list's far end. A query stops when few rows have an upper bound that
    reaches the k-th best lower bound, and their scores are resolved; rows that
    tie with the k-th stay.
    """
    n, dims = vectors.shape
    kind = _exact_type(vectors, queries)
    both = np.concatenate([vectors, -vectors], axis=1).astype(kind)
    order = np.concatenate([lists[::-1], lists], axis=1).astype(np.int64)
    shown = np.take_along_axis(both, order, axis=0)
    weights = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], axis=1).T.astype(kind)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
    least = least.copy()
    open_ = np.flatnonzero(shown[0] @ weights >= least)   # the heads alone rule out whole lists
    high, low, read = np.repeat(shown[:1], n, axis=0), np.repeat(shown[-1:], n, axis=0), 0
    for share in DEPTHS:
        if not len(open_):
            break
        upto = max(read, int(np.ceil(share * n)))
        np.put_along_axis(high, order[read:upto], shown[read:upto], axis=0)
        np.put_along_axis(low, order[read:upto], shown[read:upto], axis=0)
        np.put_along_axis(high, order[upto:], np.repeat(shown[upto - 1:upto], n - upto, axis=0), axis=0)
        read = upto
        if n >= k:
            least[open_] = np.maximum(least[open_], np.partition(low @ weights[:, open_], n - k, axis=0)[n - k].astype(np.int64))
        able = high @ weights[:, open_] >= least[open_]
        done = (able.sum(axis=0) <= max(k, n // RESOLVED)) | (read == n)
        for q, rows in zip(open_[done], able[:, done].T):
            picked = np.flatnonzero(rows)
            scores = vectors[picked] @ queries[q]
            floor = max(least[q], np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else least[q]
            out[q] = picked[scores >= floor], scores[scores >= floor]
        open_ = open_[~done]
    return out


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Packed blocks of distinct vectors with the least ids of each and the sorted list of each dimension."""
    least = W.partitionBy("vector").orderBy("vec_id")
    ranked = rows.distinct().withColumn("_at", F.row_number().over(least)).where(F.col("_at") <= most)
    distinct = materialise(ranked.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    blocks = max(1, -(-distinct.count() // BLOCK_VECTORS))
    dealt = distinct.select(
        F.size("vector").alias("dims"), F.pmod(F.xxhash64("vector"), F.lit(blocks)).alias("block"), "vector", "ids")

    def packed(key: tuple, group: pa.Table) -> pa.Table:
        dims = key[0].as_py()
        vectors = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, dims)
        lists = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        return pa.table({
            "dims": pa.array([dims], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()),
            "vectors": pa.array([vectors.tobytes()]), "lists": pa.array([lists.tobytes()]),
            "ids": pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})

    return materialise(dealt.groupBy("dims", "block").applyInArrow(packed, _BLOCK))


def _read(blocks: DataFrame, batches: DataFrame, number: int, most: int) -> DataFrame:
    """The best ``most`` rows of every block for every query of every batch of the same number of dimensions.

    A pair of a packed block and a packed batch is a group of two rows: neither side is whole in any task.
    """
    def run(key: tuple, block: pa.Table, batch: pa.Table) -> pa.Table:
        found: dict[str, list] = {name: [] for name in ("pos", "score", "vec_id")}
        if block.num_rows and batch.num_rows:
            dims = key[0].as_py()
            own = {name: block.column(name)[0] for name in ("vectors", "lists", "ids")}
            vectors, lists = (np.frombuffer(own[name].as_py(), np.int32).reshape(-1, dims).astype(np.int64) for name in ("vectors", "lists"))
            rows = batch.column("queries")[0].as_py()
            queries = np.array([r["vector"] for r in rows], np.int64).reshape(-1, dims)
            least = np.array([_LOWEST if r["least"] is None else r["least"] for r in rows], np.int64)
            for row, (picked, scores) in zip(rows, read_lists(vectors, lists, queries, least, most)):
                best = sorted((-s, i) for p, s in zip(picked.tolist(), scores.tolist()) for i in own["ids"][p].as_py())[:most]
                found["pos"] += [row["pos"]] * len(best)
                found["score"] += [-s for s, _ in best]
                found["vec_id"] += [i for _, i in best]
        n = len(found["pos"])
        return pa.table({
            "dims": pa.array([key[0].as_py()] * n, pa.int32()), "batch": pa.array([key[2].as_py()] * n, pa.int64()),
            "pos": pa.array(found["pos"], pa.int32()), "score": pa.array(found["score"], pa.int64()),
            "vec_id": pa.array(found["vec_id"], pa.int64())})

    places = blocks.select(F.col("dims").alias("dims"), F.col("block").alias("block"))
    left = blocks.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(number - 1).cast("bigint"))))
    right = batches.join(places, "dims").select("dims", "block", "batch", "queries")
    keys = ("dims", "block", "batch")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, _FOUND)


def exact_top_k(df: DataFrame, queries: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k rows with the highest integer inner product.

    ``queries`` says which rows ask; every row but those with the query's own id is
    a candidate. Equal scores go by the smaller id. Vectors become whole numbers (``vectors.whole_vectors`` says which rows
    take no part); only vectors with equally many components are compared. Rows without an id take no part; rows that repeat id and
    vector count once; rows that share an id but not the vector are candidates of their own, and as a query the smallest of
    their vectors asks. With fewer than k candidates all are returned; an empty table gives no rows.

    Equal vectors meet as one, with the k + 1 least ids each (a query's own id can be among them),
    so a very frequent vector costs no more than others. One block of candidates first
    gives every query a score that k + 1 rows reach; with it, most of the other blocks stop early.
    """
    ship_package(df.sparkSession)
    rows = materialise(whole_vectors(df, scale, None, key, vector).where("vec_id IS NOT NULL"))
    most = k + 1
    blocks = _blocks(rows, most)
    asking = rows.where(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    distinct = materialise(asking.select("vector").distinct())
    number = max(1, -(-distinct.count() // BATCH_QUERIES))
    dealt = distinct.select(F.size("vector").alias("dims"), F.pmod(F.xxhash64("vector"), F.lit(number)).alias("batch"), "vector")
    placed = materialise(dealt.withColumn("pos", F.row_number().over(W.partitionBy("dims", "batch").orderBy("vector"))))

    def batched(least: DataFrame) -> DataFrame:
        joined = placed.join(least, ["dims", "batch", "pos"], "left")
        return joined.groupBy("dims", "batch").agg(F.sort_array(F.collect_list(F.struct("pos", "vector", "least"))).alias("queries"))

    firsts = blocks.groupBy("dims").agg(F.min("block").alias("block"))
    unknown = placed.select("dims", "batch", "pos", F.lit(None).cast("bigint").alias("least"))
    begun = materialise(_read(blocks.join(firsts, ["dims", "block"], "left_semi"), batched(unknown), number, most))
    reached = begun.groupBy("dims", "batch", "pos").agg(
        F.when(F.count(F.lit(1)) >= most, F.min("score")).alias("least"))
    rest = _read(blocks.join(firsts, ["dims", "block"], "left_anti"), batched(reached), number, most)
    order = [F.desc("score"), F.asc("vec_id")]
    best = begun.unionByName(rest).withColumn("_at", F.row_number().over(W.partitionBy("dims", "batch", "pos").orderBy(*order)))
    best = best.where(F.col("_at") <= most).groupBy("dims", "batch", "pos").agg(F.collect_list(F.struct("score", "vec_id")).alias("best"))
    answers = materialise(placed.join(best, ["dims", "batch", "pos"]).select("vector", "best"))
    told = asking.withColumnRenamed("vec_id", "query_id").join(answers, "vector").select("query_id", F.inline("best"))
    told = told.where("vec_id <> query_id").withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order)))
    return told.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
