"""Quality selection by importance resampling of hashed n-gram models."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.held import Held, bounded, releasing
from meterstar.llm.inputs import carried, picked, text_mark
from meterstar.operators.ranking import order_statistics
from meterstar.session import materialise, ship_package

WORD_BUCKETS = 1 << 20       # hashed single tokens
SHAPE_BUCKETS = 1 << 14      # hashed pairs of token shapes
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
LABELLED_ROWS = 20_000       # the most labelled rows that the target model and the cut are fitted on
PRIOR = 1.0                  # added to a bucket's count and to the count expected in its place
AVOIDED = -1.5               # log ratios above this count as 0: such n-grams say little about quality
TEMPERATURE = 0.05           # of the sampling; 1 samples by the plain weight
GOOD_COST = 3                # a good labelled row on the wrong side of the cut costs as much as so many bad ones

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SHAPE_BITS = 10
_SAME = 0                    # the shape of a token that repeats the one before it
_MARKS = 8                   # shapes below are those of words


def _shape(token: str) -> int:
    if token[0].isalnum() or token[0] == "_":
        if token.isdigit():
            return 1
        if len(token) > 1 and token.isupper():
            return 2
        return 3 if token[0].isupper() else 4
    return _MARKS + xxhash.xxh3_64_intdigest(token) % ((1 << _SHAPE_BITS) - _MARKS)


class _Codes(Held):
    def make(self, token: str) -> int:
        return xxhash.xxh3_64_intdigest(token.lower()) >> _SHAPE_BITS << _SHAPE_BITS | _shape(token)


_codes = _Codes()


def features(text: str | None) -> np.ndarray:
    """Buckets of all n-grams: each token, and each pair of neighbours by shape.

    Shapes tell digits, capitals, single marks and runs of marks apart and mark a token that repeats the last one, so
    that noise is known by its form even where its words are new.
    """
    bounded()
    tokens = _TOKEN.findall(text or "")
    codes = np.fromiter(map(_codes.__getitem__, tokens), np.uint64, len(tokens))
    if not len(codes):
        return np.zeros(0, np.int64)
    names = codes >> np.uint64(_SHAPE_BITS)
    shapes = codes & np.uint64((1 << _SHAPE_BITS) - 1)
    shapes[1:][names[1:] == names[:-1]] = _SAME
    pairs = (shapes[:-1] * np.uint64(0x9E3779B97F4A7C15) + shapes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - 14)
    return np.concatenate([names % np.uint64(WORD_BUCKETS), pairs + np.uint64(WORD_BUCKETS)]).astype(np.int64)


def labelled_sample(labels: DataFrame, rows: int = LABELLED_ROWS, seed: int = 6) -> DataFrame:
    """At most ``rows`` labelled documents, by hash of their id: ``_id, _good``. A document
    with several labels is good if all say so."""
    marked = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.coalesce(
        (F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False)).alias("_good"))
    marked = marked.where("_id IS NOT NULL").groupBy("_id").agg(F.every("_good").alias("_good"))
    return marked.orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(rows)


def _counts(rows: DataFrame) -> np.ndarray:
    """Bucket counts of all rows and of the good ones; a task sends one count per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        held: list[list[np.ndarray]] = [[], []]

        def add() -> None:
            for k, found in enumerate(held):
                if found:
                    total[k] += np.bincount(np.concatenate(found), minlength=BUCKETS)
                    found.clear()

        waiting = 0
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
                found = features(text.as_py())
                held[0].append(found)
                if good:
                    held[1].append(found)
                waiting += len(found)
                if waiting >= BUCKETS:
                    add()
                    waiting = 0
        add()
        on = np.nonzero(total[0])[0]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(on), "raw": pa.array(total[0][on]), "target": pa.array(total[1][on])})

    summed = rows.select("text", "_good").mapInArrow(releasing(run), "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    summed = summed.toArrow()  # at most BUCKETS rows
    out = np.zeros((2, BUCKETS))
    for k, name in enumerate(("raw", "target")):
        out[k, summed["bucket"].to_numpy()] = summed[name].to_numpy()
    return out


def log_ratio(counts: np.ndarray, prior: float = PRIOR, avoided: float = AVOIDED) -> np.ndarray:
    """log of target over raw probability per bucket, where it is below ``avoided``; elsewhere 0.

    Single tokens and pairs are a model each. A bucket's target count is compared with
    the count it would have at the raw rate; the prior keeps rare n-grams near 0.
    """
    out = np.zeros(BUCKETS)
    for part in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, BUCKETS)):
        raw, target = counts[0, part], counts[1, part]
        expected = raw * (target.sum() / max(raw.sum(), 1.0))
        out[part] = np.log((target + prior) / (expected + prior))
    return np.where(out < avoided, out, 0.0).astype(np.float32)


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on the key alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), 11)
    return -F.log(-F.log((bits.cast("double") + 0.5) / float(1 << 53)))


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good from bad labelled rows at the least cost."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    wrong = GOOD_COST * np.concatenate([[0], np.cumsum(g)]) + np.concatenate([[0], np.cumsum(~g)])[-1] - np.concatenate([[0], np.cumsum(~g)])
    edges = np.concatenate([[True], w[1:] > w[:-1], [True]])
    places = np.nonzero(edges & (wrong == wrong[edges].min()))[0]
    at = int(places[len(places) // 2])
    if at == 0:
        return -np.inf
    return float(w[-1] + 1) if at == len(w) else float((w[at - 1] + w[at]) / 2)


def selection(df: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, temperature: float = TEMPERATURE,
              seed: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents drawn by importance: ``doc_id, n_features, log_weight, sampling_key, kept``.

    The target model counts the n-grams of labelled good documents (quality 1,
    not toxic; at most ``labelled_rows`` labels are used), the raw model those of all documents.
    A document's log weight is the sum of its n-grams' log ratios, of those that the target clearly avoids, over the
    root of its length, so that neither plain words nor length decide. The
    number to draw, k, is the number of documents whose weight is above the cut that
    best parts the labelled rows; the k largest of weight / temperature plus Gumbel noise are drawn, which is a
    sample without replacement in proportion to the (tempered) weights.

    What reaches the driver is bounded: bucket counts and labelled weights. A text without
    tokens has weight 0. NULL keys draw noise of their own common key. Rows that repeat key and text share their fate.
    Without labels of both kinds everything is kept. An empty table gives no rows.
    """
    return _marked_selection(df, labels, labelled_rows, temperature, seed, key, text).drop("text_mark")


def _marked_selection(df: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, temperature: float = TEMPERATURE,
                      seed: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``selection`` with the ``text_mark`` of each row."""
    spark = df.sparkSession
    ship_package(spark)
    rows = picked(df, doc_id=key, text=text).withColumns({"doc_id": F.col("doc_id").cast("bigint"), "text_mark": text_mark("text")})
    sample = F.broadcast(materialise(labelled_sample(labels, labelled_rows, seed)))  # at most labelled_rows rows
    rows = rows.join(sample, F.col("doc_id") == F.col("_id"), "left")
    sent = spark.sparkContext.broadcast(log_ratio(_counts(rows)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weights = [], []
            for t in batch.column(1):
                found = features(t.as_py())
                n.append(len(found))
                weights.append(float(sent.value[found].sum(dtype=np.float64)) / max(len(found), 1) ** 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(n, pa.int64()), pa.array(weights, pa.float64())],
                ["doc_id", "_good", "text_mark", "n_features", "log_weight"])

    weighed = materialise(rows.select("doc_id", "text", "_good", "text_mark").mapInArrow(
        releasing(weigh), "doc_id bigint, _good boolean, text_mark bigint, n_features bigint, log_weight double"))
    known = weighed.where("_good IS NOT NULL").groupBy("doc_id").agg(
        F.min("log_weight").alias("log_weight"), F.first("_good").alias("_good")).collect()  # at most labelled_rows rows
    good = np.array([r["_good"] for r in known], bool)
    cut = best_cut(np.array([r["log_weight"] for r in known]), good) if good.any() and not good.all() else -np.inf
    drawn = weighed.withColumn("sampling_key", F.col("log_weight") / F.lit(temperature) + gumbel(F.col("doc_id"), seed))
    total, k = drawn.agg(F.count(F.lit(1)), F.count_if(F.col("log_weight") >= F.lit(cut))).first()
    names = ["doc_id", "text_mark", "n_features", "log_weight", "sampling_key"]
    if k == total:
        return drawn.select(*names, F.lit(True).alias("kept"))
    if k == 0:
        return drawn.select(*names, F.lit(False).alias("kept"))
    least = order_statistics(drawn, [(F.col("sampling_key"), total - k)], [total])[0]
    return drawn.select(*names, (F.col("sampling_key") >= F.lit(least)).alias("kept"))


def good_documents(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that are drawn, all columns included; rows that share a key, or have none, are judged one by one."""
    gone = _marked_selection(df, labels, key=key, text=text, **options).where("NOT kept").select(
        F.col("doc_id").alias("_gone"), F.col("text_mark").alias("_gone_mark")).distinct()
    same = F.col("_own_key").eqNullSafe(F.col("_gone")) & (F.col("_own_mark") == F.col("_gone_mark"))
    return carried(df, key, text).join(gone, same, "left_anti").select("_row.*")
