"""Token files with directly addressable codes.

An id is cut into chunks, lowest first. Level 0 holds the lowest chunk of every
id, level k the next chunk of those ids that need one; a bitmap per level marks
the ids that go on, and a rank directory counts the marks before each block.
Any id is found by one look and one rank per level, without decoding a block.

File: magic, then the segments of at most ``SEGMENT_TOKENS`` ids each, then the
footer (NumPy arrays: chunk widths, segment places, document ids, starts),
then the footer's length and the magic again.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.llm.inputs import file_system, new_folder, picked, shuffle_partitions
from meterstar.llm.tokens import ID_BYTES, encoder
from meterstar.operators.ranking import ordered_prefix
from meterstar.session import materialise, ship_package

MAGIC = b"TOKCODE1"
SEGMENT_TOKENS = 1 << 20
FILE_TOKENS = 4 << 20
RANK_BITS = 512
_ID_BITS = 32
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def chunk_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths with the least total size for these ids: one marks bit per chunk but the last."""
    bits = np.zeros(_ID_BITS + 2, np.int64)
    if len(ids):
        lengths = np.frompyfunc(int.bit_length, 1, 1)(np.unique(ids).astype(object)).astype(np.int64)
        counts = np.unique(ids, return_counts=True)[1]
        np.add.at(bits, np.maximum(lengths, 1), counts)
    top = max(int(np.max(np.nonzero(bits)[0], initial=1)), 1)
    more = [int(bits[k + 1:].sum()) for k in range(top + 1)]  # ids with more than k bits
    more[0] = int(bits.sum())
    best: dict[int, tuple[int, list[int]]] = {top: (0, [])}
    for at in range(top - 1, -1, -1):
        best[at] = min(
            (more[at] * (nxt - at + (nxt < top)) + best[nxt][0], [nxt - at, *best[nxt][1]]) for nxt in range(at + 1, top + 1)
        )
    return best[0][1]


def _packed(values: np.ndarray, width: int) -> bytes:
    bits = np.empty((len(values), width), np.uint8)
    for j in range(width):
        bits[:, j] = (values >> np.uint32(j)) & np.uint32(1)
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def _unpacked(data: bytes, n: int, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    out = np.zeros(n, np.uint32)
    for j in range(width):
        out |= bits[:, j].astype(np.uint32) << np.uint32(j)
    return out


class Segment:
    """Up to ``SEGMENT_TOKENS`` ids as chunk levels with marks and rank directories."""

    def __init__(self, widths: list[int], levels: list[tuple[int, bytes, bytes, np.ndarray]]):
        self.widths, self.levels = widths, levels  # count, chunks, marks, ranks

    @classmethod
    def encode(cls, ids: np.ndarray, widths: list[int]) -> Segment:
        levels, rest = [], ids.astype(np.uint32)
        for k, width in enumerate(widths):
            last = k == len(widths) - 1
            chunk = rest & np.uint32((1 << width) - 1)
            rest = rest >> np.uint32(width) if width < _ID_BITS else np.zeros_like(rest)
            goes_on = np.zeros(len(rest), bool) if last else rest > 0
            marks, ranks = b"", np.zeros(0, np.uint32)
            if not last:
                marks = np.packbits(goes_on, bitorder="little").tobytes()
                starts = np.arange(0, max(len(rest), 1), RANK_BITS)
                ranks = np.concatenate([[0], np.cumsum(goes_on)])[starts].astype("<u4")
            levels.append((len(chunk), _packed(chunk, width), marks, ranks))
            rest = rest[goes_on]
        return cls(widths, levels)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for count, chunks, marks, ranks in self.levels:
            out.write(struct.pack("<QQQQ", count, len(chunks), len(marks), len(ranks)))
            out.write(chunks + marks + ranks.tobytes())
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes, widths: list[int]) -> Segment:
        levels, at = [], 0
        for _ in widths:
            count, chunks, marks, ranks = struct.unpack_from("<QQQQ", data, at)
            at += 32
            body = data[at:at + chunks + marks + 4 * ranks]
            levels.append((count, body[:chunks], body[chunks:chunks + marks], np.frombuffer(body, "<u4", ranks, chunks + marks)))
            at += len(body)
        return cls(widths, levels)

    def __len__(self) -> int:
        return self.levels[0][0]

    def access(self, i: int) -> int:
        """The id at position ``i``: one chunk and at most one rank on each level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for width, (_, chunks, marks, ranks) in zip(self.widths, self.levels):
            first, end = i * width, (i + 1) * width
            raw = int.from_bytes(chunks[first // 8:-(-end // 8)], "little")
            value |= ((raw >> first % 8) & ((1 << width) - 1)) << shift
            shift += width
            if not marks or not marks[i // 8] >> i % 8 & 1:
                break
            block = i // RANK_BITS
            before = int.from_bytes(marks[block * RANK_BITS // 8:i // 8 + 1], "little") & ((1 << (i - block * RANK_BITS)) - 1)
            i = int(ranks[block]) + before.bit_count()
        return value

    def decode(self) -> np.ndarray:
        """All ids, level by level from the last."""
        higher = np.zeros(0, np.uint32)
        for width, (count, chunks, marks, _) in zip(self.widths[::-1], self.levels[::-1]):
            out = _unpacked(chunks, count, width)
            if marks:
                on = np.unpackbits(np.frombuffer(marks, np.uint8), count=count, bitorder="little").astype(bool)
                out[on] |= higher << np.uint32(width)
            higher = out
        return higher


class TokenFile:
    """Random access to a written file; reads only the footer and the segments it needs."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(8 + len(MAGIC), size - 8 - len(MAGIC))
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        length = struct.unpack("<Q", tail[:8])[0]
        footer = np.load(io.BytesIO(self.file.read_at(length, size - 8 - len(MAGIC) - length)))
        self.widths = footer["widths"].tolist()
        self.places, self.doc_ids = footer["places"], footer["doc_ids"]
        self.named, self.starts = footer["named"].astype(bool), footer["starts"]

    def segment(self, k: int) -> Segment:
        return Segment.from_bytes(self.file.read_at(int(self.places[k + 1] - self.places[k]), int(self.places[k])), self.widths)

    def token(self, i: int) -> int:
        return self.segment(i // SEGMENT_TOKENS).access(i % SEGMENT_TOKENS)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Document id, start in the file, ids as bytes; one segment is held at a time."""
        at, held = -1, np.zeros(0, np.uint32)
        for doc, named, start, end in zip(self.doc_ids.tolist(), self.named.tolist(), self.starts.tolist(), self.starts[1:].tolist()):
            parts, i = [], start
            while i < end:
                k = i // SEGMENT_TOKENS
                if k != at:
                    at, held = k, self.segment(k).decode()
                upto = min(end, (k + 1) * SEGMENT_TOKENS)
                parts.append(held[i - k * SEGMENT_TOKENS:upto - k * SEGMENT_TOKENS].astype("<u4").tobytes())
                i = upto
            yield doc if named else None, start, b"".join(parts)


class _Writer:
    """Writes one file: under a name of its own first, then renamed, so that a repeated task replaces it whole."""

    def __init__(self, uri: str):
        self.uri, (self.system, self.path) = uri, file_system(uri)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.own = f"{self.path}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
        self.out = self.system.open_output_stream(self.own)
        self.out.write(MAGIC)
        self.places, self.doc_ids, self.starts = [len(MAGIC)], [], [0]
        self.waiting: list[bytes] = []
        self.waiting_bytes, self.widths = 0, None

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids) // ID_BYTES)
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= SEGMENT_TOKENS * ID_BYTES:
            self._flush(False)

    def _flush(self, end: bool) -> None:
        data, whole = b"".join(self.waiting), SEGMENT_TOKENS * ID_BYTES
        if self.widths is None:  # of the file's first segment; later ids that need more bits get a further level
            self.widths = chunk_widths(np.frombuffer(data[:whole], "<u4"))
            if sum(self.widths) < _ID_BITS:
                self.widths.append(_ID_BITS - sum(self.widths))
        cut = 0
        while len(data) - cut >= whole or end and cut < len(data):
            body = Segment.encode(np.frombuffer(data[cut:cut + whole], "<u4"), self.widths).to_bytes()
            self.out.write(body)
            self.places.append(self.places[-1] + len(body))
            cut += whole
        self.waiting, self.waiting_bytes = [data[cut:]], max(0, len(data) - cut)

    @property
    def tokens(self) -> int:
        return self.starts[-1]

    def close(self) -> None:
        self._flush(True)
        footer = io.BytesIO()
        np.savez(footer, widths=np.array(self.widths, np.int64), places=np.array(self.places, np.int64),
                 doc_ids=np.array([d or 0 for d in self.doc_ids], np.int64),
                 named=np.array([d is not None for d in self.doc_ids], np.uint8), starts=np.array(self.starts, np.int64))
        self.out.write(footer.getvalue() + struct.pack("<Q", footer.tell()) + MAGIC)
        self.out.close()
        self.system.move(self.own, self.path)


def write_tokens(df: DataFrame, tokenizer: str, spaces_count: bool = False, end_id: int | None = 2, folder: str | None = None,
                 key: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Tokenize whole texts and write their ids in ascending key order; returns the manifest.

    The texts are range-partitioned by key and sorted, then encoded and written
    where they are. A task streams its documents: it holds one segment, and starts a
    new file after ``file_tokens`` ids. The manifest has one row per file:
    ``part, file, uri, documents, tokens, before`` (ids in all files before it).
    Keys are whole numbers; NULL keys come last; rows that repeat a key are all written, in the order of their texts; a
    NULL or empty text has only the end id; an empty table gives no file.
    """
    spark = df.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "tokens")
    rows = picked(df, doc_id=key, text=text)
    by = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = rows.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by, F.col("text"))
    end = b"" if end_id is None else end_id.to_bytes(ID_BYTES, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(tokenizer, spaces_count), TaskContext.get().partitionId()
        written, now = [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc_id, ids in zip(some.column(0).to_pylist(), own.encode(texts)):
                    if now is None:
                        now = _Writer(f"{folder}/part-{part:06d}-{len(written):06d}.tok")
                    now.add(doc_id, ids + end)
                    if now.tokens >= file_tokens:
                        now.close()
                        written.append(now)
                        now = None
        if now is not None:
            now.close()
            written.append(now)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * len(written), pa.int64()), "file": pa.array(list(range(len(written))), pa.int64()),
            "uri": pa.array([w.uri for w in written], pa.string()),
            "documents": pa.array([len(w.doc_ids) for w in written], pa.int64()),
            "tokens": pa.array([w.tokens for w in written], pa.int64()),
        })

    manifest = materialise(rows.mapInArrow(write, "part bigint, file bigint, uri string, documents bigint, tokens bigint"))
    counted = ordered_prefix(manifest, [F.col("part"), F.col("file")], {"_upto": F.col("tokens")})
    return materialise(counted.withColumn("before", F.col("_upto") - F.col("tokens")).drop("_upto"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the manifest's files: ``doc_id, start, ids``; one file is open in a task at a time."""
    spark = manifest.sparkSession
    ship_package(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "ids"]
        types = [pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, size = [], 0
                for doc_id, start, ids in TokenFile(uri).documents():
                    held.append((doc_id, before + start, ids))
                    size += len(ids)
                    if size >= 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    files = manifest.select("uri", "before").repartition(shuffle_partitions(spark), "uri")
    return files.mapInArrow(read, "doc_id bigint, start bigint, ids binary")
