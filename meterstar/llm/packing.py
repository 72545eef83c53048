"""First-fit decreasing packing of token sequences, in random groups of documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked
from meterstar.llm.tokens import ID_BYTES, tokenized
from meterstar.session import ship_package

GROUP_DOCUMENTS = 4096      # about as many documents in a group at most,
GROUP_BYTES = 8 << 20       # and about as many bytes of text
_GROUP_SHIFT = 32  # a sequence id is the group above these bits, the bin below


class BinTree:
    """Free room of bins under a tournament: every inner node holds the larger room of its two children."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1
        while self.leaves < max(bins, 1):
            self.leaves *= 2
        self.most = [room] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put ``length`` into the first bin with room for it; the bin and its room before."""
        most, node = self.most, 1
        if most[1] < length:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if most[node] < length:
                node += 1
        room = most[node]
        most[node] = room - length
        at, node = node - self.leaves, node // 2
        while node:
            larger = max(most[2 * node], most[2 * node + 1])
            if most[node] == larger:
                break
            most[node] = larger
            node //= 2
        return at, room


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length; none may exceed the capacity."""
    tree = BinTree(len(lengths), capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at, room = tree.place(lengths[i])
        out[i] = (at, capacity - room)
    return out


def pack(tokens: DataFrame, capacity: int = 2048, group_documents: int = GROUP_DOCUMENTS, documents: int | None = None,
         seed: int = 3, text_bytes: int = 0, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Pack rows ``doc_id, ids`` into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids, doc_tokens,
    sequence_id, offset``. A document longer than the capacity is cut into full
    pieces and a rest. Documents are dealt to groups by a hash of their id and ids; the
    number of groups follows ``documents`` and ``text_bytes``, so that a group has about
    ``group_documents`` of them and ``group_bytes`` of text at most, whatever the size of the corpus. A task holds
    one group's ids. The groups of a rerun are the same. A document without
    ids gives no piece; rows that repeat an id are packed one by one; NULL ids
    are packed like others; an empty table gives no rows.
    """
    if documents is None:
        documents = tokens.count()
    groups = max(1, -(-documents // group_documents), -(-text_bytes // group_bytes))
    dealt = tokens.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "ids"), F.lit(groups)))
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def one_group(key: tuple, group: pa.Table) -> pa.Table:
        cut = [  # document, start, length
            (i, start, min(capacity, n - start))
            for i, ids in enumerate(group.column("ids").to_pylist()) for n in [len(ids or b"") // ID_BYTES]
            for start in range(0, n, capacity)
        ]
        ids, names = group.column("ids"), group.column("doc_id")
        # Equal lengths go in the order of the ids, so that the order of arrival doesn't matter.
        named = [v if v is not None else 0 for v in names.to_pylist()]
        order = sorted(range(len(names)), key=lambda i: (not names[i].is_valid, named[i], ids[i].as_py() or b""))
        place = {i: k for k, i in enumerate(order)}
        cut.sort(key=lambda c: (place[c[0]], c[1]))
        placed = first_fit_decreasing([c[2] for c in cut], capacity)
        first = key[0].as_py() << _GROUP_SHIFT
        picks = pa.array([c[0] for c in cut], pa.int64())
        own = [ids[c[0]].as_py()[c[1] * ID_BYTES:(c[1] + c[2]) * ID_BYTES] for c in cut]
        return pa.table({
            "doc_id": names.take(picks),
            "start": pa.array([c[1] for c in cut], pa.int64()),
            "length": pa.array([c[2] for c in cut], pa.int64()),
            "ids": pa.array(own, pa.binary()),
            "doc_tokens": pa.array([len(ids[c[0]].as_py()) // ID_BYTES for c in cut], pa.int64()),
            "sequence_id": pa.array([first + at for at, _ in placed], pa.int64()),
            "offset": pa.array([o for _, o in placed], pa.int64()),
        })

    return dealt.groupBy("_group").applyInArrow(
        one_group, f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def pack_texts(df: DataFrame, tokenizer: str, spaces_count: bool = True, end_id: int | None = 1, capacity: int = 2048,
               key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Tokenize texts with the tokenizer file ``tokenizer`` and pack them; see ``pack``."""
    ship_package(df.sparkSession)
    rows = picked(df, doc_id=key, text=text)
    size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return pack(tokenized(rows, tokenizer, spaces_count, end_id), capacity, documents=size[0], text_bytes=size[1], **options)
