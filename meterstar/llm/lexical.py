"""Ranked lexical search by MaxScore with bounds for pairs of terms.

The index is a table of shards, each with the postings of some documents. A second table holds, per shard, the
intersection lists of the most frequent terms' pairs with the largest joint impacts. A search reads both.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked
from meterstar.session import materialise, ship_package

SHARD_DOCUMENTS = 4096
SHARD_WORDS = 1 << 20        # a shard ends with the document that reaches either number
PAIRED_TERMS = 64            # terms of most documents, whose pairs have lists
BATCH_ITEMS = 256            # items that read a shard together
# ASCII other than letters and digits separates terms; only A-Z are folded.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_SHARD = ("shard bigint, n_docs bigint, n_words bigint, doc_ids array<bigint>, lengths binary, terms binary, starts binary, "
          "places binary, counts binary")
_PAIRS = "shard bigint, paired array<binary>, lists binary, joint binary, best binary"


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and all characters from U+0080, with A-Z folded; NULL has none."""
    return (text or "").encode().translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    """How much a term counts that ``holding`` of all documents have."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(own_weight: int, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a term adds to each document's score; ``lengths`` are the documents' length factors."""
    counts = counts.astype(np.int64)
    return own_weight * (1_000_000_000 * counts // (1000 * counts + 8 * lengths))


def length_factors(words: np.ndarray, documents: int, all_words: int) -> np.ndarray:
    return 100 - 90 + 90 * words.astype(np.int64) * documents // max(all_words, 1)


class Postings:
    """One shard's postings: per term the places of its documents, ascending, and how often they have it."""

    def __init__(self, row: dict, documents: int, all_words: int):
        terms = row["terms"].split(b" ") if row["terms"] else []
        self.number = {t: i for i, t in enumerate(terms)}
        self.starts, self.places = np.frombuffer(row["starts"], np.int32), np.frombuffer(row["places"], np.int32)
        self.counts = np.frombuffer(row["counts"], np.int32)
        self.factors = length_factors(np.frombuffer(row["lengths"], np.int64), documents, all_words)
        self._known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

    def list_of(self, term: bytes, own_weight: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of a term; empty if the shard lacks it."""
        if term not in self._known:
            i = self.number.get(term)
            a, b = (self.starts[i], self.starts[i + 1]) if i is not None else (0, 0)
            at = self.places[a:b]
            self._known[term] = at, impacts(own_weight, self.counts[a:b], self.factors[at])
        return self._known[term]


def _shards(rows: DataFrame) -> DataFrame:
    """Postings of rows ``doc_id, text``; documents without a term are left out."""
    def packed(shard: int, ids: list, lengths: list[int], numbers: dict, words: list[np.ndarray]) -> pa.RecordBatch:
        place = np.repeat(np.arange(len(ids), dtype=np.int64), lengths)
        terms = np.array(list(numbers), object)
        order = np.argsort(terms)                            # bytes in ascending order
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pairs, counts = np.unique(rank[np.concatenate(words)] * len(ids) + place, return_counts=True)
        starts = np.searchsorted(pairs // len(ids), np.arange(len(terms) + 1)).astype(np.int32)
        cells = [shard, len(ids), sum(lengths), ids, np.array(lengths, np.int64).tobytes(), b" ".join(terms[order]),
                 starts.tobytes(), (pairs % len(ids)).astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
        names = [field.split(" ")[0] for field in _SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        ids, lengths, words = [], [], []
        numbers: dict[bytes, int] = defaultdict(itertools.count().__next__)
        total = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                own = terms_of(text.as_py())
                if not own:
                    continue
                ids.append(doc_id.as_py())
                lengths.append(len(own))
                words.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
                total += len(own)
                if len(ids) >= SHARD_DOCUMENTS or total >= SHARD_WORDS:
                    yield packed(shard, ids, lengths, numbers, words)
                    shard, ids, lengths, words, total = shard + 1, [], [], [], 0
                    numbers = defaultdict(itertools.count().__next__)
        if ids:
            yield packed(shard, ids, lengths, numbers, words)

    return rows.mapInArrow(run, _SHARD)


def _document_counts(shards: DataFrame) -> DataFrame:
    """``term, df``: how many documents hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts in zip(batch.column("terms"), batch.column("starts")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.as_py().split(b" "), pa.binary()), pa.array(np.diff(np.frombuffer(starts.as_py(), np.int32)).astype(np.int64))],
                    ["term", "df"])

    return shards.select("terms", "starts").mapInArrow(run, "term binary, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def joint_maxima(postings: Postings, paired: dict[bytes, int], size: int, best: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Of the terms in ``paired`` (with their weights) that the shard has: the lists of all pairs.

    Returns the terms, per pair (i < j, in order) the documents that have both as
    a bit row, the largest joint impact, and the ``best``-th largest (0 if there are fewer).
    """
    own = [t for t in paired if t in postings.number]
    dense = np.zeros((len(own), size), np.int64)
    for i, t in enumerate(own):
        at, impact = postings.list_of(t, paired[t])
        dense[i, at] = impact
    lists, joint, least = [], [], []
    for i, j in itertools.combinations(range(len(own)), 2):
        both = (dense[i] > 0) & (dense[j] > 0)
        sums = np.where(both, dense[i] + dense[j], 0)
        lists.append(np.packbits(both))
        joint.append(sums.max(initial=0))
        least.append(np.partition(sums, size - best)[size - best] if size >= best else 0)
    return own, np.array(lists, np.uint8), np.array(joint, np.int64), np.array(least, np.int64)


def _pair_lists(shards: DataFrame, paired: dict[bytes, int], documents: int, all_words: int, best: int) -> DataFrame:
    def run(key: tuple, shard: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0]
        own, lists, joint, least = joint_maxima(Postings(row, documents, all_words), paired, row["n_docs"], best)
        return pa.table({"shard": pa.array([row["shard"]], pa.int64()), "paired": pa.array([own], pa.list_(pa.binary())),
                         "lists": pa.array([lists.tobytes()]), "joint": pa.array([joint.tobytes()]), "best": pa.array([least.tobytes()])})

    return shards.groupBy("shard").applyInArrow(run, _PAIRS)


@dataclass
class Index:
    """An inverted index: tables of shards, pair lists and terms, and the corpus counts."""

    shards: DataFrame
    pairs: DataFrame
    terms: DataFrame
    documents: int
    words: int
    best: int


def build_index(df: DataFrame, best: int = 10, paired_terms: int = PAIRED_TERMS, key: str = "doc_id", text: str = "text") -> Index:
    """Index whole texts; keys are whole numbers.

    Documents without a term (NULL and empty texts among them) are not in the index. Rows that repeat a key are
    documents of their own; NULL keys stay NULL. A shard holds at most ``SHARD_DOCUMENTS`` documents and ends with the one that
    reaches ``SHARD_WORDS`` words. ``best`` is the number of results that the pair lists' thresholds serve.
    """
    ship_package(df.sparkSession)
    rows = picked(df, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    shards = materialise(_shards(rows))
    terms = materialise(_document_counts(shards))
    documents, words = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    frequent = terms.orderBy(F.desc("df"), "term").limit(paired_terms).collect()
    paired = {bytes(t): weight(documents, n) for t, n in frequent}
    pairs = materialise(_pair_lists(shards, paired, documents, words, best))
    return Index(shards, pairs, terms, documents, words, best)


class PairBounds:
    """The pair lists of one shard."""

    def __init__(self, row: dict, size: int):
        self.number = {t: i for i, t in enumerate(row["paired"])}
        n = len(self.number)
        self.joint, self.best = np.frombuffer(row["joint"], np.int64), np.frombuffer(row["best"], np.int64)
        self.lists = np.frombuffer(row["lists"], np.uint8).reshape(n * (n - 1) // 2, -1) if n > 1 else np.zeros((0, 0), np.uint8)
        self.size = size

    def pair(self, a: bytes, b: bytes) -> int | None:
        i, j = self.number.get(a), self.number.get(b)
        if i is None or j is None:
            return None
        i, j = min(i, j), max(i, j)
        return i * (2 * len(self.number) - i - 1) // 2 + j - i - 1

    def members(self, pair: int) -> np.ndarray:
        return np.unpackbits(self.lists[pair], count=self.size).view(bool)


def search_shard(postings: Postings, bounds: PairBounds, item: list[tuple[bytes, int]], least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents that can be among an item's k best; equal k-th scores stay.

    ``least`` is a score that k other documents are known to reach. Terms go by their largest impact. Those whose bounds
    together stay under the threshold need not be read for candidates; they only complete
    the documents found by the others, while a bound on what they can still add reaches the threshold.
    A pair of such terms adds at most its joint maximum where both occur, and the larger single maximum elsewhere.
    """
    lists = {t: postings.list_of(t, w) for t, w in item if w > 0}
    most = {t: int(v.max()) for t, (at, v) in lists.items() if len(at) and v.max() > 0}
    terms = sorted(most, key=lambda t: (most[t], t))
    least = max(least, 1)
    for t in terms:
        if len(lists[t][0]) >= k:
            least = max(least, int(np.partition(lists[t][1], -k)[-k]))
    known = {}
    frequent = [t for t in terms if t in bounds.number]
    for a, b in itertools.combinations(frequent, 2):
        pair = bounds.pair(a, b)
        known[a, b] = known[b, a] = pair
        least = max(least, int(bounds.best[pair]))
    # Bounds of the terms with the smallest impacts; each new term pairs with the partner that saves most.
    upto, partner, total, single = [0], {}, 0, []
    steps: list[dict[bytes, bytes]] = [{}]
    for t in terms:
        gain = 0
        if t in bounds.number:
            saved = [(most[t] + most[u] - max(int(bounds.joint[known[t, u]]), most[t], most[u]), u) for u in single]
            gain, u = max(saved, default=(0, b""))
            if gain:
                partner[t], partner[u] = u, t
                single.remove(u)
            else:
                single.append(t)
        total += most[t] - gain
        upto.append(total)
        steps.append(dict(partner))
        if total >= least:
            break
    optional = next((i for i, bound in enumerate(upto) if bound >= least), len(terms) + 1) - 1
    if optional >= len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    score = np.zeros(bounds.size, np.int64)
    for t in terms[optional:]:
        at, impact = lists[t]
        score[at] += impact
    found = np.flatnonzero(score)
    if len(found) >= k:
        least = max(least, int(np.partition(score[found], -k)[-k]))
    if optional:
        rest = np.zeros(len(found), np.int64)
        for t, u in steps[optional].items():
            if t < u:
                both = bounds.members(known[t, u])[found]
                rest += np.where(both, bounds.joint[known[t, u]], max(most[t], most[u]))
        rest += sum(most[t] for t in terms[:optional] if t not in steps[optional])
        found = found[score[found] + rest >= least]
    for i in range(optional - 1, -1, -1):
        found = found[score[found] + upto[i + 1] >= least]
        if not len(found):
            break
        at, impact = lists[terms[i]]
        j = np.minimum(np.searchsorted(at, found), len(at) - 1)
        score[found] += np.where(at[j] == found, impact[j], 0)
    if len(found) >= k:
        least = max(least, int(np.partition(score[found], -k)[-k]))
    found = found[score[found] >= least]
    return found, score[found]


def _ranked(index: Index, shards: DataFrame, batches: DataFrame, number: int, k: int) -> DataFrame:
    """Each item's k best documents of every shard, as far as they reach the item's threshold."""
    documents, words = index.documents, index.words

    def run(key: tuple, shard: pa.Table, batch: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if shard.num_rows and batch.num_rows:
            row = shard.to_pylist()[0]
            postings, bounds, ids = Postings(row, documents, words), PairBounds(row, row["n_docs"]), row["doc_ids"]
            for item in batch.column("items")[0].as_py():
                own = [(t["term"], weight(documents, t["df"])) for t in item["terms"]]
                places, scores = search_shard(postings, bounds, own, item["least"] or 0, k)
                best = sorted((-s, ids[p] is None, ids[p] or 0) for p, s in zip(places.tolist(), scores.tolist()))[:k]
                out += [(item["item_id"], None if no_id else doc_id, -s) for s, no_id, doc_id in best]
        return pa.table({"item_id": pa.array([x[0] for x in out], pa.int64()), "doc_id": pa.array([x[1] for x in out], pa.int64()),
                         "score": pa.array([x[2] for x in out], pa.int64())})

    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(number - 1).cast("bigint"))
    left = shards.join(index.pairs, "shard").withColumn("batch", F.explode(numbers))
    wanted = shards.select(F.col("shard").alias("shard")).withColumn("batch", F.explode(numbers))
    right = wanted.join(batches, "batch")
    return left.groupBy("shard", "batch").cogroup(right.groupBy("shard", "batch")).applyInArrow(
        run, "item_id bigint, doc_id bigint, score bigint")


def _item_terms(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = list(Counter(terms_of(text)))
                yield pa.RecordBatch.from_arrays([pa.array([item_id] * len(own), pa.int64()), pa.array(own, pa.binary())], ["item_id", "term"])

    return items.mapInArrow(run, "item_id bigint, term binary")


def search(index: Index, items: DataFrame, k: int | None = None, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest scores above 0 for each item.

    Equal scores go by the smaller document id (NULL last). Keys of items are whole numbers; items without a key take no
    part, and rows that repeat one are one item with the terms of all. Items without a term that
    the corpus has give no rows; so does an empty index. ``k`` is the index's ``best`` unless given, and
    must not be larger. One shard first gives every item a score that k documents reach.
    Items and shards meet in packed groups, so neither is whole in any task.
    """
    k = index.best if k is None else k
    if not 0 < k <= index.best:
        raise ValueError(f"k must be between 1 and {index.best}")
    wanted = picked(items, item_id=key, text=text).withColumn("item_id", F.col("item_id").cast("bigint")).where("item_id IS NOT NULL")
    terms = _item_terms(wanted).distinct().join(index.terms, "term")
    own = materialise(terms.groupBy("item_id").agg(F.collect_list(F.struct("term", "df")).alias("terms")))
    number = max(1, -(-own.count() // BATCH_ITEMS))

    def batched(least: DataFrame) -> DataFrame:
        dealt = own.join(least, "item_id", "left").withColumn("batch", F.pmod(F.xxhash64("item_id"), F.lit(number)))
        return materialise(dealt.groupBy("batch").agg(F.collect_list(F.struct("item_id", "least", "terms")).alias("items")))

    first = index.shards.agg(F.min("shard")).first()[0]
    unknown = own.select("item_id", F.lit(None).cast("bigint").alias("least"))
    begun = materialise(_ranked(index, index.shards.where(F.col("shard") == F.lit(first)), batched(unknown), number, k))
    reached = begun.groupBy("item_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    rest = _ranked(index, index.shards.where(F.col("shard") != F.lit(first)), batched(reached), number, k)
    best = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = begun.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
