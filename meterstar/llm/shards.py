"""Rendezvous sharding: every shard scores a record's key, the highest score takes it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked
from meterstar.operators.ranking import row_index

_DIGITS = 13  # hexadecimal digits of the digest that make the draw: 52 bits fit a double exactly
NULL_KEY = "null"


def draw(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY)) for p in parts]))
    whole = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")
    return (whole.cast("double") + 0.5) / float(16**_DIGITS)


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key. A shard's share of keys is its weight's share.

    A new shard only takes keys; nothing moves between the others. Changing
    one weight moves keys to or from that shard only.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("at least one shard is needed, and every weight must be positive")
    scored = [
        F.struct((F.lit(-float(w)) / F.log(draw(key, F.lit(shard)))).alias("score"), F.lit(-shard).alias("shard"))
        for shard, w in sorted(weights.items())
    ]
    best = reduce(lambda a, b: F.greatest(a, b), scored) if len(scored) > 1 else scored[0]
    return (-best["shard"]).cast("int")


def assign(df: DataFrame, weights: Mapping[int, float], grown: Mapping[int, float] | None = None,
           key: str = "doc_id", text: str = "text", order: Sequence[str] = ("text_crc32", "size")) -> DataFrame:
    """Place every row: ``doc_id, size, text_crc32, shard, slot`` and, with ``grown``, ``grown_shard``.

    ``size`` is the text's UTF-8 bytes plus one, ``slot`` a gapless position in
    the shard by key. Texts are reduced to size and checksum before anything
    moves; slots come from one range sort over (shard, key), so a shard of any
    size is spread over many tasks. A NULL text counts as empty, NULL keys share
    the shard of the word "null" and take its last slots, rows that repeat a key share its shard and
    take neighbouring slots, an empty table gives no rows, other columns are not read.
    """
    rows = picked(df, doc_id=key, text=text)
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select(
        "doc_id", (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), rendezvous(F.col("doc_id"), weights).alias("shard"),
        *([rendezvous(F.col("doc_id"), grown).alias("grown_shard")] if grown else []),
    )
    placed = row_index(rows, [F.col("shard"), F.col("doc_id").asc_nulls_last(), *[F.col(c) for c in order]], "_at")
    starts = placed.groupBy("shard").agg(F.min("_at").alias("_start"))  # one row per shard
    return (
        placed.join(F.broadcast(starts), "shard")
        .withColumn("slot", F.col("_at") - F.col("_start")).drop("_at", "_start")
    )


def write_shards(df: DataFrame, weights: Mapping[int, float], path: str, key: str = "doc_id") -> None:
    """Write whole rows as Parquet, one folder ``shard=N`` per shard, each filled by many tasks."""
    name = "shard"
    while name in df.columns:
        name = f"_{name}"
    df.withColumn(name, rendezvous(F.col(f"`{key}`"), weights)).write.partitionBy(name).parquet(path)


def slot_gaps(placed: DataFrame) -> DataFrame:
    """Shards whose slots are not exactly 0 .. rows - 1; no row means all are sound."""
    counts = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("low"),
                                         F.max("slot").alias("high"), F.sum("slot").alias("total"))
    n = F.col("n")
    return counts.where((F.col("low") != 0) | (F.col("high") != n - 1) | (F.col("total") != n * (n - 1) / 2))
