"""Near-duplicate documents by one-permutation MinHash."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.components import components
from meterstar.llm.held import releasing
from meterstar.llm.inputs import carried, picked, shuffle_partitions
from meterstar.llm.words import mixed, shingle_set
from meterstar.session import materialise, ship_package

SHINGLE_WORDS = 5
BANDS, ROWS = 24, 4       # a pair of similarity 0.8 misses all bands once in 300,000, one of 0.85 once in 50 million
BLOCK = 256               # documents of an open bucket that meet as many others in one task
CHUNK = 64                # documents that share one copy of their centre's text
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash: the least hash of each bin, empty bins filled by optimal densification.

    ``shingles`` are sorted distinct 64-bit hashes. The high bits choose the
    bin, so each bin's least hash is its first. An empty bin takes the value of
    a bin drawn by a hash of the empty bin and the attempt, the same for all documents, until that one
    was filled from the start.
    """
    out = np.full(bins, _EMPTY)
    at = ((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    filled, first = np.unique(at.astype(np.int64), return_index=True)
    out[filled] = shingles[first]
    known = np.zeros(bins, bool)
    known[filled] = True
    waiting, attempt = np.nonzero(~known)[0], 1
    while len(waiting):
        drawn = (mixed(waiting.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = known[drawn]
        out[waiting[hit]] = mixed(out[drawn[hit]] + np.uint64(attempt))
        waiting, attempt = waiting[~hit], attempt + 1
    return out


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = signature(shingles, bands * rows).reshape(bands, rows)
    keys = np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, j])
    return keys.view(np.int64)


def _signatures(rows: DataFrame, width: int, bands: int, band_rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, banded = [], [], []
            for text in batch.column(1):
                own = shingle_set(text.as_py(), width)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                banded.append(band_keys(own, bands, band_rows) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(banded, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"])

    return rows.mapInArrow(releasing(run), "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, least: Fraction) -> DataFrame:
    """Of the pairs ``centre, other``, those whose full shingle sets are alike enough.

    The others of a centre come in chunks; each chunk brings the centre's text
    once, before theirs, and a task streams them: it holds the sets of one centre and one other.
    """
    degree = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("_n"))
    chunked = pairs.join(degree, "centre").withColumn(
        "chunk", F.pmod(F.xxhash64("other"), F.ceil(F.col("_n") / CHUNK))).select("centre", "other", "chunk")
    others = chunked.join(texts, F.col("other") == F.col("doc_id")).select("centre", "chunk", F.lit(1).alias("turn"), "doc_id", "text")
    centres = chunked.select("centre", "chunk").distinct().join(texts, F.col("centre") == F.col("doc_id")).select(
        "centre", "chunk", F.lit(0).alias("turn"), "doc_id", "text")
    up, down = least.numerator, least.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            a, b = [], []
            for centre, chunk, turn, doc_id, text in zip(*batch.columns):
                own = shingle_set(text.as_py(), width)
                if not turn.as_py():
                    at, held = (centre.as_py(), chunk.as_py()), own
                    continue
                if at != (centre.as_py(), chunk.as_py()):
                    raise ValueError("a chunk came without its centre")
                shared = len(np.intersect1d(held, own, assume_unique=True))
                if down * shared >= up * (len(held) + len(own) - shared):
                    a.append(centre.as_py())
                    b.append(doc_id.as_py())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    parts = shuffle_partitions(pairs.sparkSession)
    dealt = centres.unionByName(others).repartition(parts, "centre", "chunk").sortWithinPartitions("centre", "chunk", "turn")
    return dealt.mapInArrow(releasing(run), "a bigint, b bigint")


def near_duplicates(df: DataFrame, similarity: float = 0.8, width: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of near-duplicates: ``doc_id, n_shingles, component_id, kept`` for every row.

    Two documents are linked if their shingle sets (distinct runs of ``width``
    lower-cased words; a shorter text is one run) have a Jaccard similarity of
    at least ``similarity``, checked on the full sets. Equal sets become one first.
    Candidates are documents that share a band of their MinHash; inside a bucket
    they are compared with a centre only, a star. Buckets whose documents
    are then still in several components are settled block by block, only across components.
    So no pair in a bucket is left unsettled, yet groups of copies cost one star.

    ``component_id`` is the smallest id reachable, ``kept`` marks it. Keys are whole numbers.
    A text without words links with nothing. A NULL key links with nothing either and is kept (component NULL). Rows that repeat a key
    share its component, whichever of their texts has the link. An empty table gives no rows.
    """
    spark = df.sparkSession
    ship_package(spark)
    least = Fraction(str(similarity))
    rows_in = picked(df, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    keys = None
    if _repeats(rows_in):
        # Each row is a document of its own until the links are known.
        numbered = materialise(rows_in.withColumn("row", F.monotonically_increasing_id()))
        keys = numbered.select("row", F.col("doc_id").alias("key"))
        rows_in = numbered.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text")
    signed = materialise(_signatures(rows_in, width, bands, rows))
    sets = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    # Written first: a join of two plain inputs can have a large group of copies split over tasks.
    own = materialise(sets.groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    same = sets.select("doc_id", "set_key").join(own, "set_key").where("doc_id <> rep").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    reps = sets.join(own, (sets["set_key"] == own["set_key"]) & (sets["doc_id"] == own["rep"]), "left_semi")
    entries = reps.dropDuplicates(["set_key"]).select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    entries = materialise(entries.join(buckets, "band"))

    links = _links(entries, rows_in, width, bands, rows, least)
    links = same.unionByName(links)
    if keys is not None:
        links = links.join(keys.select(F.col("row").alias("a"), F.col("key").alias("x")), "a").join(
            keys.select(F.col("row").alias("b"), F.col("key").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        # Rows without a key have no number here and stay as they are.
        of_rows = signed.join(keys, signed["doc_id"] == keys["row"], "left")
        signed = of_rows.select(F.col("key").alias("doc_id"), "n_shingles")
    found = components(links)
    return (
        signed.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
    )


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())


def _settled(members: DataFrame, texts: DataFrame, width: int, bands: int, rows: int, least: Fraction) -> DataFrame:
    """All links between different components within the open buckets ``band, doc_id, component, size``.

    A bucket is cut into parts of about ``BLOCK`` documents, and every two parts meet in one
    task, so no pair is a row of its own. Documents join as links are found, and those that are
    joined are not compared again. A pair is compared only in the first band that it shares.
    """
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    own = members.withColumn("_parts", parts).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("_parts")).cast("int"))
    own = own.select("band", "doc_id", "component", "own", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("with"))
    own = own.select("band", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "component",
                     F.col("doc_id").alias("member"))
    up, down = least.numerator, least.denominator

    def compare(block: list) -> list[tuple[int, int]]:
        group = {component: component for _, component, _, _, _ in block}

        def root(c: int) -> int:
            while group[c] != c:
                group[c] = group[group[c]]
                c = group[c]
            return c

        found = []
        for x, (side, component, doc, shingles, keys) in enumerate(block):
            for side_y, component_y, doc_y, shingles_y, keys_y in block[:x]:
                if between and side == side_y:
                    continue
                n, m = len(shingles), len(shingles_y)
                if down * min(n, m) < up * max(n, m) or root(component) == root(component_y):
                    continue
                if keys[np.argmax(keys == keys_y)] != band:
                    continue
                both = _shared(shingles, shingles_y)
                if down * both >= up * (n + m - both):
                    found.append((doc, doc_y))
                    group[root(component)] = root(component_y)
        return found

    between, band = False, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal between, band
        at, block = None, []
        for batch in batches:
            links = []
            for own_band, i, j, side, component, doc, text in zip(*[c.to_pylist() for c in batch.columns]):
                if at != (own_band, i, j):
                    links += compare(block) if block else []
                    at, block, band, between = (own_band, i, j), [], own_band, i != j
                shingles = shingle_set(text, width)
                block.append((side, component, doc, shingles, band_keys(shingles, bands, rows)))
            if links:
                yield _link_batch(links)
        if block:
            yield _link_batch(compare(block))

    dealt = own.join(texts, F.col("member") == F.col("doc_id")).select("band", "i", "j", "own", "component", "doc_id", "text")
    dealt = dealt.repartition(shuffle_partitions(members.sparkSession), "band", "i", "j").sortWithinPartitions("band", "i", "j", "doc_id")
    return dealt.mapInArrow(releasing(run), "a bigint, b bigint")


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _links(entries: DataFrame, rows_in: DataFrame, width: int, bands: int, rows: int, least: Fraction) -> DataFrame:
    """Confirmed links among the bucket entries ``band, doc_id, n_shingles, least, size``; enough of them to join all that belong together."""
    wanted = entries.select("doc_id").distinct()
    texts = materialise(rows_in.join(wanted, "doc_id", "left_semi"))
    fits = (F.least("n_shingles", "centre_shingles") * least.denominator
            >= F.greatest("n_shingles", "centre_shingles") * least.numerator)
    centres = entries.where("doc_id = least").select("band", F.col("doc_id").alias("centre"), F.col("n_shingles").alias("centre_shingles"))
    pairs = entries.where("doc_id <> least").join(centres, "band").where(fits).select("centre", F.col("doc_id").alias("other")).distinct()
    links = materialise(_confirmed(materialise(pairs), texts, width, least))
    found = materialise(components(links))
    now = entries.where("size > 2").join(found, F.col("doc_id") == F.col("node"), "left").select(
        "band", "doc_id", "size", F.coalesce("component", "doc_id").alias("component"))
    open_bands = now.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low < _high")
    now = now.join(open_bands.select("band"), "band", "left_semi")
    return links.unionByName(materialise(_settled(now, texts, width, bands, rows, least)))


def _repeats(rows: DataFrame) -> bool:
    """Whether any key repeats."""
    counts = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.where("n > 1").isEmpty()


def without_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose key is kept, all columns included; of rows that repeat a key all stay."""
    gone = near_duplicates(df, key=key, text=text, **options).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return carried(df, key, text).join(gone, F.col("_own_key") == F.col("_gone"), "left_anti").select("_row.*")
