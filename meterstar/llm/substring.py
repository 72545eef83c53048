"""Removal of long passages that already occur in an earlier document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.held import releasing
from meterstar.llm.inputs import carried, picked, text_mark
from meterstar.llm.words import hashes, mixed, windows, words
from meterstar.session import materialise, ship_package

# Perfect difference sets, by period. Any two positions modulo the
# period can be moved by one common shift onto members of the set.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

LENGTH = 50
PERIOD = 31
FILTER_BITS_EACH = 32
_PROBES = (0, 12, 23, 34)   # each probe reads the anchor's 64 bits from another place
LEAST_FILTER_BITS, MOST_FILTER_BITS = 1 << 16, 1 << 30   # at most 128 MB are sent to the executors
_PAGE_BITS = 32768      # of Spark's bitmap functions
_SECOND = np.uint64(0xD6E8FEB86659FD93)   # makes the other half of a run's hash independent of the first
_LAST = (1 << 63) - 1   # a missing key comes after all others


def covered(period: int) -> np.ndarray:
    """Which positions modulo the period are anchors."""
    on = np.zeros(period, bool)
    on[list(COVERS[period])] = True
    return on


def _anchors(h: np.ndarray, length: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the cover and hashes of the windows there; the windows are short enough
    that any run of ``length`` words holds one at every shift below the period."""
    found = windows(h, length - period + 1)
    if len(h) < length:
        return np.zeros(0, np.int64), found[:0]
    at = np.nonzero(covered(period)[np.arange(len(found)) % period])[0]
    return at, found[at]


def _second(h: np.ndarray, length: int) -> np.ndarray:
    """The other 64 bits of the 128 that tell runs of ``length`` words apart; ``windows`` gives the first."""
    return windows(mixed(h ^ _SECOND), length)


def _filter(shared: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap that has the bit of every hash in column ``anchor``; its size is bounded, whatever the corpus."""
    bits = LEAST_FILTER_BITS
    rows = shared.count()
    while bits < min(FILTER_BITS_EACH * rows, MOST_FILTER_BITS):
        bits *= 2
    # Each probe is another cut of the hash's 64 bits.
    cuts = [F.shiftrightunsigned("anchor", shift).bitwiseAND(F.lit(bits - 1)) + 1 for shift in _PROBES]
    at = F.explode(F.array(*cuts)).alias("at")
    pages = shared.select(at).groupBy(F.bitmap_bucket_number("at").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in pages.toLocalIterator():
        first = (row["page"] - 1) * _PAGE_BITS // 8
        out[first:first + _PAGE_BITS // 8] = np.frombuffer(row["bits"], np.uint8)[:bits // 8 - first]
    return out, bits


def _passing(found: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes the bitmap may hold: all that it does hold, and a few others."""
    on = np.ones(len(found), bool)
    for shift in _PROBES:
        bit = (found >> np.uint64(shift)) & np.uint64(bits - 1)
        on &= (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return on


def _candidates(h: np.ndarray, bitmap: np.ndarray, bits: int, length: int, period: int) -> np.ndarray:
    """Starts of the windows of ``length`` words that hold a shared anchor."""
    at, found = _anchors(h, length, period)
    at = at[_passing(found, bitmap, bits)]
    if not len(at):
        return at
    last = len(h) - length
    edges = np.zeros(last + 2, np.int64)
    np.add.at(edges, np.clip(at - (period - 1), 0, last + 1), 1)
    np.add.at(edges, np.clip(at + 1, 0, last + 1), -1)
    return np.nonzero(np.cumsum(edges[:-1]) > 0)[0]


def repeated_passages(df: DataFrame, length: int = LENGTH, period: int = PERIOD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words to remove from each document, and what is left.

    A word goes if one of the windows of ``length`` words over it also starts in a document
    with a smaller key; windows are judged on the input. Returns ``doc_id, text_mark, n_words,
    n_removed, kept_sha256, kept_text`` (``text_mark`` of the input; the kept words joined by a space, NULL if nothing is removed).

    Windows of ``length - period + 1`` words are hashed only at the positions of a
    difference cover. Two equal runs of ``length`` words have such an anchor at
    a common place, whatever their positions, so a run without an anchor that occurs in two documents is not
    repeated. A shared anchor is extended to every run of ``length`` words around it; each such run is
    hashed whole to 128 bits (no words are compared again), and the least key of each hash decides. No pairs of
    documents are made, however many share a passage.

    First the shared anchors, then the repeated runs go to the executors as a bitmap that is at most
    ``MOST_FILTER_BITS`` large; beyond that it lets more runs through to the join, which decides, and the result is the same.
    Keys are whole numbers; a missing key counts as larger than all others. Rows that repeat a
    key do not remove from each other. A NULL text has no words. An empty table gives no rows.
    """
    if not 0 < period < length or period not in COVERS:
        raise ValueError(f"the period must be one of {sorted(COVERS)} and shorter than the length")
    spark = df.sparkSession
    ship_package(spark)
    rows = picked(df, doc_id=key, text=text).withColumns({"doc_id": F.col("doc_id").cast("bigint"), "text_mark": text_mark("text")})

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_anchors(hashes(t.as_py()), length, period)[1]) for t in batch.column(1)]
            joined = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(joined.view(np.int64))})

    shared = materialise(
        rows.mapInArrow(releasing(anchors), "anchor bigint").groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor"))
    bitmap, bits = _filter(shared)
    sent = spark.sparkContext.broadcast(bitmap.tobytes())

    def emitted(batches: Iterator[pa.RecordBatch], places_of) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = hashes(t.as_py())
                at = places_of(h)
                if len(at):
                    run, more = windows(h, length), _second(h, length)
                    own = (np.full(len(at), _LAST if doc_id is None else doc_id, np.int64),
                           np.full(len(at), xxhash.xxh3_64_intdigest(h.tobytes()), np.uint64).view(np.int64),
                           at.astype(np.int32), run[at].view(np.int64), more[at].view(np.int64))
                    for column, values in zip(columns, own):
                        column.append(values)
            if columns[0]:
                whole = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["id", "print", "place", "run", "more"])
                for at in range(0, whole.num_rows, 100_000):
                    yield whole.slice(at, 100_000)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(sent.value, np.uint8)
        return emitted(batches, lambda h: _candidates(h, own, bits, length, period))

    schema = "id bigint, print bigint, place int, run bigint, more bigint"
    # Written first: a join of two plain inputs can have a very common run split over tasks.
    first = materialise(rows.mapInArrow(releasing(candidates), schema).groupBy("run", "more").agg(
        F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("run", "more", "low"))
    known, known_bits = _filter(first.select(F.col("run").alias("anchor")))
    sent_runs = spark.sparkContext.broadcast(known.tobytes())
    sent.unpersist()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(sent_runs.value, np.uint8)
        return emitted(batches, lambda h: np.nonzero(_passing(windows(h, length), own, known_bits))[0])

    repeats = rows.mapInArrow(releasing(repeated), schema).join(first, ["run", "more"]).where("id > low")
    spans = repeats.groupBy("id", "print").agg(F.collect_set("place").alias("places"))  # at most one per word of the document

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(sent_runs.value, np.uint8)
        for batch in batches:
            counts, prints, sums, texts = [], [], [], []
            for t in batch.column(1):
                text = t.as_py()
                found = words(text)
                h = hashes(text)
                counts.append(len(found))
                prints.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63))
                sums.append(hashlib.sha256(b" ".join(found)).hexdigest())
                texts.append(text if _passing(windows(h, length), own, known_bits).any() else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(prints, pa.int64()), pa.array(sums),
                 pa.array(texts, pa.string())],
                ["doc_id", "text_mark", "n_words", "print", "kept_sha256", "text"])

    whole = rows.mapInArrow(releasing(bodies), "doc_id bigint, text_mark bigint, n_words bigint, print bigint, kept_sha256 string, text string")
    spans = spans.select(F.col("id").alias("_id"), F.col("print").bitwiseXOR(F.lit(-(1 << 63))).alias("_print"), "places")
    joined = whole.join(spans, (F.coalesce("doc_id", F.lit(_LAST)) == F.col("_id")) & (F.col("print") == F.col("_print")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, sums, texts = [], batch.column(3).to_pylist(), []
            for i, places in enumerate(batch.column(5)):
                if not places.is_valid:
                    gone.append(0)
                    texts.append(None)
                    continue
                found = words(batch.column(4)[i].as_py())
                edges = np.zeros(len(found) + 1, np.int64)
                starts = np.unique(places.values.to_numpy())
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + length, -1)
                kept = np.cumsum(edges[:-1]) == 0
                left = b" ".join([found[k] for k in np.nonzero(kept)[0]])
                gone.append(len(found) - int(kept.sum()))
                sums[i] = hashlib.sha256(left).hexdigest()
                texts.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(gone, pa.int64()), pa.array(sums, pa.string()),
                 pa.array(texts, pa.string())],
                ["doc_id", "text_mark", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return joined.select("doc_id", "text_mark", "n_words", "kept_sha256", "text", "places").mapInArrow(
        releasing(cut), "doc_id bigint, text_mark bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length_column: str | None = "n_chars", **options) -> DataFrame:
    """``df`` with repeated passages cut from its texts, and ``length_column``, if it has one, brought up to date.

    Rows that share a key, or have none, are each cut by their own text.
    """
    cut = repeated_passages(df, key=key, text=text, **options).where("kept_text IS NOT NULL").select(
        F.col("doc_id").alias("_cut_id"), F.col("text_mark").alias("_cut_mark"), F.col("kept_text").alias("_cut_text"),
    ).dropDuplicates(["_cut_id", "_cut_mark"])
    same = F.col("_own_key").eqNullSafe(F.col("_cut_id")) & (F.col("_own_mark") == F.col("_cut_mark"))
    joined = carried(df, key, text).join(cut, same, "left")
    changed = {text: F.coalesce("_cut_text", F.col("_row")[text])}
    if length_column in df.columns:
        old = F.col("_row")[length_column]
        changed[length_column] = F.when(F.col("_cut_text").isNull(), old).otherwise(F.length("_cut_text")).cast(df.schema[length_column].dataType)
    return joined.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in df.columns])
