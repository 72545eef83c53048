"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked, text_mark
from meterstar.operators.ranking import ordered_prefix
from meterstar.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
_OFFSET_DIGITS = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def offset(source: Column, seed: int) -> Column:
    """The source's one random offset in [0, 1)."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, _OFFSET_DIGITS), 16, 10).cast("bigint") / float(16**_OFFSET_DIGITS)


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source: rows, source_size, target, and the rows of the sources before it.

    The sources, by code point with NULL last, weigh ``weights`` in turn and
    share ``share`` times all sizes. A target stops at ``most`` times its
    source's size; the excess goes to the others by weight until none is above.
    Ordered by size per weight, the stopped sources come first, so running sums
    show where that ends without repeating the sharing.
    """
    sources = sized.groupBy("source").agg(F.sum("repeats").alias("rows"), F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
    sources = ordered_prefix(sources, [F.col("source").asc_nulls_last()], {"_place": F.lit(1).cast("bigint"), "_upto": F.col("rows")})
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    sources = sources.select(
        "source", "rows", "source_size", (F.col("_upto") - F.col("rows")).alias("rows_before"),
        F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).cast("bigint").alias("weight"),
    )
    sources = sources.withColumn("_full", F.col("source_size") / F.col("weight"))
    filled = materialise(ordered_prefix(
        sources, [F.col("_full"), F.col("source").asc_nulls_last()], {"_size": F.col("source_size"), "_weight": F.col("weight")}
    ))
    total, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return filled.select("source", "rows", "source_size", "rows_before", F.lit(0.0).alias("target"))
    level = (F.lit(share * total) - F.lit(float(most)) * (F.col("_size") - F.col("source_size"))) / (
        F.lit(weight) - F.col("_weight") + F.col("weight"))
    below = filled.withColumn("_level", level).where(F.col("_full") * most > F.col("_level"))
    found = below.agg(F.min_by("_level", F.struct("_full", F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()))).first()[0]
    full = F.col("source_size") * float(most)
    target = full if found is None else F.least(full, F.lit(found) * F.col("weight"))
    return filled.select("source", "rows", "source_size", "rows_before", target.alias("target"))


def _expected(df: DataFrame, weights: Sequence[int], share: float, most: float, seed: int, key: str, text: str, source: str) -> DataFrame:
    """Per distinct (key, source, size): ``source_size, target, repeats, rate, shift`` and ``before``, the source's documents before it."""
    rows = picked(df, doc_id=key, text=text, source=source)
    sized = rows.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = materialise(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("repeats")))
    targets = materialise(source_targets(sized, weights, share, most))
    ordered = ordered_prefix(
        sized, [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last()], {"_upto": F.col("repeats")},
    ).withColumnRenamed("source", "_source")
    joined = ordered.join(targets, F.col("_source").eqNullSafe(F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", "repeats", rate.alias("rate"), offset(F.col("source"), seed).alias("shift"),
        (F.col("_upto") - F.col("repeats") - F.col("rows_before")).alias("before"))


def _copies(number: Column) -> Column:
    """Whole numbers crossed by the step of the ``number``-th of a key's repeats."""
    rank = F.col("before") + number
    return (F.floor(rank * F.col("rate") + F.col("shift")) - F.floor((rank - 1) * F.col("rate") + F.col("shift"))).cast("bigint")


def plan(df: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 5,
         key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often each document is emitted: ``doc_id, source, size, source_size, target, copies, taken``, a row per document.

    Every document of a source expects target / source_size copies. Along the
    source, largest documents first, these add up; a document is emitted once
    for every whole number that its step (plus the source's offset) crosses.
    That gives floor or ceiling of the expectation, so at most ``most`` rounded up, and
    neighbours of like size stand in for each other, so words taken come near
    the target. The running sum is rank times expectation, and ranks come from
    one range sort over (source, size, key): a source of any size is spread over many tasks.
    A NULL or empty text has size 0, a NULL source is a source of its own (last), NULL keys are keys like others,
    rows that repeat key, source and size follow each other and are planned one by one, an empty table gives no rows.
    """
    expected = _expected(df, weights, share, most, seed, key, text, source)
    each = expected.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("repeats"))))
    return each.withColumn("copies", _copies(F.col("_number"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(df: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 5,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed rows themselves: every row of ``df`` as often as planned, all its columns kept.

    Only a few planned numbers and the rows meet in one join on the key. Rows that repeat key, source and size are
    numbered, by a hash of their text, to share the copies planned for them. Columns of any name may come along.
    """
    planned = materialise(_expected(df, weights, share, most, seed, key, text, source).select(
        F.col("doc_id").alias("_key"), F.col("source").alias("_source"), F.col("size").alias("_size"), "repeats", "rate", "shift", "before"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{key}`").alias("_own_key"),
                     F.col(f"`{source}`").alias("_own_source"), word_count(F.col(f"`{text}`")).alias("_own_size"), text_mark(text).alias("_mark"))
    on = [F.col(f"_own{c}").eqNullSafe(F.col(c)) for c in ("_key", "_source", "_size")]
    single = rows.join(planned.where("repeats = 1").withColumn("_copies", _copies(F.lit(1))).where("_copies > 0"), on).select("_row", "_copies")
    among = W.partitionBy("_own_key", "_own_source", "_own_size").orderBy("_mark")
    several = rows.join(planned.where("repeats > 1"), on).withColumn("_copies", _copies(F.row_number().over(among))).select("_row", "_copies")
    return (
        single.unionByName(several).where("_copies > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select("_row.*")
    )
