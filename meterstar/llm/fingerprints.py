"""Document fingerprints: sums of wide vectors hashed from paragraphs.

A paragraph (line) is hashed to a vector with two parts: 4 numbers modulo 2**64
that are uniform, and 256 numbers modulo 2**32 that add +1 or -1 for each of
the paragraph's clauses. A document's fingerprint is the sum over its paragraphs, so it
does not depend on their order, equal multisets of paragraphs have equal
fingerprints, and a paragraph is inserted or deleted by adding or subtracting
its vector. The mean square of the second part estimates the squared length of
the clause counts, so two fingerprints tell how alike the documents are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked, shuffle_partitions
from meterstar.session import ship_package

EXACT_LANES = 4     # modulo 2**64
SIGN_LANES = 256    # modulo 2**32: a text of 2 GB, the longest there is, has fewer clauses than would wrap a lane
_AT_ONCE = 4096
_CLAUSE = re.compile(r"[^.!?;:,|]+")


class Fingerprint:
    """A sum of paragraph vectors."""

    __slots__ = ("exact", "signs")

    def __init__(self, exact: np.ndarray | None = None, signs: np.ndarray | None = None):
        self.exact = np.zeros(EXACT_LANES, np.uint64) if exact is None else exact
        self.signs = np.zeros(SIGN_LANES, np.uint32) if signs is None else signs

    @classmethod
    def of_paragraphs(cls, paragraphs: Sequence[str]) -> Fingerprint:
        out = cls()
        for at in range(0, len(paragraphs), _AT_ONCE):
            some = paragraphs[at:at + _AT_ONCE]
            digests = b"".join([hashlib.blake2b(p.encode(), digest_size=8 * EXACT_LANES).digest() for p in some])
            out.exact = out.exact + np.frombuffer(digests, "<u8").reshape(-1, EXACT_LANES).sum(0, dtype=np.uint64)
            clauses = [c for p in some for c in map(str.strip, _CLAUSE.findall(p)) if c]
            for first in range(0, len(clauses), _AT_ONCE):
                part = clauses[first:first + _AT_ONCE]
                drawn = b"".join([hashlib.blake2b(c.encode(), digest_size=SIGN_LANES // 8, person=b"clause").digest() for c in part])
                ones = np.unpackbits(np.frombuffer(drawn, np.uint8).reshape(len(part), -1), axis=1).sum(0, dtype=np.int64)
                out.signs = out.signs + (2 * ones - len(part)).astype(np.uint32)
        return out

    @classmethod
    def of_text(cls, text: str | None) -> Fingerprint:
        """An empty text has no paragraph."""
        return cls.of_paragraphs(text.split("\n")) if text else cls()

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.signs + other.signs)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.signs - other.signs)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.hex() == other.hex()

    __hash__ = None

    def hex(self) -> str:
        return self.exact.astype("<u8").tobytes().hex() + self.signs.astype("<u4").tobytes().hex()

    @classmethod
    def from_hex(cls, text: str) -> Fingerprint:
        data = bytes.fromhex(text)
        return cls(np.frombuffer(data, "<u8", EXACT_LANES).astype(np.uint64),
                   np.frombuffer(data, "<u4", SIGN_LANES, 8 * EXACT_LANES).astype(np.uint32))

    def _length(self) -> float:
        return float(np.mean(np.square(self.signs.astype(np.int32).astype(np.float64))))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints; otherwise the estimated share of clauses in common, 0 to 1."""
        if np.array_equal(self.exact, other.exact) and np.array_equal(self.signs, other.signs):
            return 1.0
        both = self._length() + other._length()
        return max(0.0, 1.0 - (self - other)._length() / both) if both else 0.0


def replaced_end(text: str, fingerprint: Fingerprint, keep: int, new_end: str) -> tuple[str, Fingerprint]:
    """``text`` with all after its first ``keep`` characters replaced, and its fingerprint.

    Only the paragraphs from the cut on are hashed: the old ones are
    subtracted, the new ones added.
    """
    if not text:
        return new_end, Fingerprint.of_text(new_end)
    edited = text[:keep] + new_end
    if not edited:
        return "", Fingerprint()
    line = text.rfind("\n", 0, keep) + 1
    old, new = text[line:].split("\n"), edited[line:].split("\n")
    return edited, fingerprint - Fingerprint.of_paragraphs(old) + Fingerprint.of_paragraphs(new)


def with_neighbours(rows: DataFrame) -> DataFrame:
    """Rows ``doc_id, text`` dealt so that a task streams neighbours by descending id (then by hash of the text, then by text).

    Adds ``part`` and ``head``: after a part's rows comes, with ``head`` true, a copy of
    the next part's first row (after the last part: the first's). Texts are
    shuffled once, each part to a task of its own. Parts are cut at quantiles of the ids; an id that fills several quantiles, and rows
    without an id, are cut further by the hash of their texts. Only one id and hash per part visits the driver.
    """
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    at = F.lit([(i + 1) / parts for i in range(parts - 1)] or [0.5])
    cuts, without, total = rows.agg(
        F.percentile_approx("doc_id", at, 10_000), F.count_if(F.col("doc_id").isNull()), F.count(F.lit(1))).first()
    bounds, filled = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    filled = np.append(np.where(filled > 1, filled, 0), 0)  # parts of a bound's own rows; above the highest bound there are none
    steps = np.append(filled[::-1] + 1, 0).cumsum()
    starts = steps - np.append(filled[::-1] + 1, 0)           # first part of each interval, the highest ids first
    last = int(steps[-1])
    for_none = max(1, -(-without * parts // total)) if total else 1

    def cut_by(marks: np.ndarray, pieces: np.ndarray | int) -> np.ndarray:
        return np.minimum((marks / 2.0**64 + 0.5) * pieces, pieces - 1).astype(np.int64)

    @F.pandas_udf("int")
    def part_of(ids: pd.Series, known: pd.Series, marks: pd.Series) -> pd.Series:
        ids, marks = ids.to_numpy(), marks.to_numpy().astype(np.float64)
        interval = np.searchsorted(bounds, ids, side="left")
        pieces = filled[interval]
        own = (pieces > 0) & (np.append(bounds, 0)[interval] == ids)
        found = starts[len(bounds) - interval] + np.where(own, cut_by(marks, pieces), pieces)
        return pd.Series(np.where(known.to_numpy(), found, last + cut_by(marks, for_none)).astype(np.int32))

    mark = F.xxhash64("text")
    part = part_of(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNotNull(), mark)
    dealt = rows.select("doc_id", "text", mark.alias("mark"), part.alias("part"))
    # The complement of a hash is largest where the hash is least. One row per part.
    firsts = dealt.groupBy("part").agg(F.max(F.struct("doc_id", F.bitwise_not("mark").alias("rest"))).alias("first")).orderBy("part").collect()
    heads = [(firsts[(i + 1) % len(firsts)]["first"]["doc_id"], ~firsts[(i + 1) % len(firsts)]["first"]["rest"], firsts[i]["part"])
             for i in range(len(firsts))]
    heads = spark.createDataFrame(heads, "_id bigint, _mark bigint, _part int")
    first = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_id")) & (mark == F.col("_mark")))
    first = first.groupBy("doc_id", "_mark", "_part").agg(F.min("text").alias("text"))
    both = dealt.withColumn("head", F.lit(False)).unionByName(
        first.select("doc_id", "text", F.col("_mark").alias("mark"), F.col("_part").alias("part"), F.lit(True).alias("head")))
    order = ["part", "head", F.col("doc_id").desc_nulls_last(), "mark", "text"]
    return both.repartitionById(last + for_none, F.col("part")).sortWithinPartitions(*order).select("doc_id", "text", "part", "head")


def fingerprints(df: DataFrame, edited_share: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edit, and how alike they are.

    The edit replaces the last ``n_chars // edited_share`` code points by as many
    (or all) of the next document, by descending key, after the last the first.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Keys are whole numbers; NULL keys come last; rows that repeat a key
    are neighbours in the order of their texts' hashes; a NULL text is empty; a single row is its own next; an empty table
    gives no rows. A task holds two documents at a time.
    """
    ship_package(df.sparkSession)
    rows = picked(df, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some, out = batch.slice(at, 512), []
                for doc_id, body, part, head in zip(*[c.to_pylist() for c in some.columns]):
                    own = Fingerprint.of_text(body)
                    if before is not None and before[2] == part:
                        last_id, last, _, print_ = before
                        cut = len(last) // edited_share
                        edited, changed = replaced_end(last, print_, len(last) - cut, body[:cut])
                        out.append((last_id, len(last), hashlib.sha256(edited.encode()).hexdigest(), print_.hex(), changed.hex(),
                                    print_.likeness(changed), print_.likeness(own)))
                    before = None if head else (doc_id, body, part, own)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return with_neighbours(rows).mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
