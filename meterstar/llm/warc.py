"""WARC archives: a Python data source that plans by file and reads headers first.

``format("warc")`` rows have the columns of ``SCHEMA``. Filters on the header
columns are pushed into the scan: a record's header is parsed, and if a filter rejects it, its
block is skipped, neither read from an uncompressed file nor decoded.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from meterstar.llm.inputs import file_system, new_folder, picked
from meterstar.session import ship_package

SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, "
          "refers_to string, payload_digest string, payload_length bigint, payload binary")
PAYLOAD = "payload"
# Names and texts of the archive format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "application/http;msgtype=response"
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "content_type": "Content-Type", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
IN_BRACKETS = ("record_id", "refers_to")
NO_DATE = "1970-01-01T00:00:00Z"

ROLL_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2048
MANIFEST = "_manifest.json"
LEAST_REVISITED = 100


def _header(name: str, value: str) -> bytes:
    """One header line; line breaks in a value would end it and become spaces."""
    return f"{name}: {' '.join(value.splitlines())}\r\n".encode()


def record_bytes(row: dict) -> bytes:
    """One record. The block of an HTTP response or a revisit is its HTTP head and the payload."""
    payload, length = row["payload"] or b"", row["payload_length"]
    revisit = row["record_type"] == "revisit"
    content_type = row["content_type"] or (HTTP_RESPONSE if row["record_type"] in ("response", "revisit") else None)
    block = payload
    if content_type == HTTP_RESPONSE:
        whole = len(payload) if length is None else length
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {whole}\r\n\r\n".encode()
        block += b"" if revisit else payload
    out = [VERSION, b"\r\n"]
    for column, name in HEADERS.items():
        value = content_type if column == "content_type" else row.get(column) or (NO_DATE if column == "date" else None)
        if value is not None:
            out.append(_header(name, f"<{value}>" if column in IN_BRACKETS else value))
    if revisit:
        out.append(_header("WARC-Profile", REVISIT_PROFILE))
    out.append(_header("Content-Length", str(len(block))))
    return b"".join([*out, b"\r\n", block, b"\r\n\r\n"])


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Streams each task's rows to files of its own; only files that the commit lists count."""

    def __init__(self, options: dict):
        self.folder, self.zipped = options["path"], options.get("compression") == "gzip"
        self.roll = int(options.get("rollbytes", ROLL_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = file_system(self.folder)
        system.create_dir(folder, recursive=True)
        own, files, out, size = uuid.uuid4().hex, [], None, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None or size >= self.roll:
                        if out is not None:
                            out.close()
                        files.append(f"{own}-{len(files):05d}.warc" + ".gz" * self.zipped)
                        out, size = system.open_output_stream(f"{folder}/{files[-1]}", compression=None, buffer_size=1 << 20), 0
                    data = record_bytes(row)
                    data = gzip.compress(data, 6, mtime=0) if self.zipped else data  # a member for each record
                    out.write(data)
                    size += len(data)
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        system, folder = file_system(self.folder)
        system.create_dir(folder, recursive=True)
        # One list per write: an archive that is appended to keeps what it has.
        with system.open_output_stream(f"{folder}/{uuid.uuid4().hex}{MANIFEST}") as out:
            out.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())

    def abort(self, messages: list) -> None:
        system, folder = file_system(self.folder)
        for name in [f for m in messages if m for f in m.files]:
            system.delete_file(f"{folder}/{name}")


def _test(f: Filter) -> Callable[[dict], bool] | None:
    """The filter as a test of the parsed header, or None if the header can't decide it."""
    if isinstance(f, Not):
        inner = _test(f.child)
        if inner is None or isinstance(f.child, (EqualNullSafe, IsNull, IsNotNull)):  # never unknown
            return inner and (lambda row: not inner(row))
        known = _column(f.child)
        if known is None:
            return None
        if isinstance(f.child, In) and None in f.child.value:  # false or unknown for every row
            return lambda row: False
        return lambda row: row.get(known) is not None and not inner(row)
    column = _column(f)
    if column is None or column in (PAYLOAD, "payload_length"):
        return None
    if isinstance(f, IsNull):
        return lambda row: row.get(column) is None
    if isinstance(f, IsNotNull):
        return lambda row: row.get(column) is not None
    if isinstance(f, EqualNullSafe):
        return lambda row: row.get(column) == f.value
    compare = {EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a.encode() > b.encode(),
               GreaterThanOrEqual: lambda a, b: a.encode() >= b.encode(), LessThan: lambda a, b: a.encode() < b.encode(),
               LessThanOrEqual: lambda a, b: a.encode() <= b.encode(), StringStartsWith: str.startswith,
               StringEndsWith: str.endswith, StringContains: lambda a, b: b in a}.get(type(f))
    return compare and (lambda row: row.get(column) is not None and compare(row[column], f.value))


def _column(f: Filter) -> str | None:
    names = getattr(f, "attribute", ())
    return names[0] if len(names) == 1 and names[0] in (*HEADERS, "payload_length", PAYLOAD) else None


@dataclass
class WarcFile(InputPartition):
    path: str


def parse_header(lines: bytes) -> tuple[dict, int]:
    """The columns of a record's header, and its block's length. Folded lines continue the one before."""
    named: dict[str, str] = {}
    last = ""
    for line in lines.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and last:
            named[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if colon:
            last = name.strip().decode("utf-8", "replace").lower()
            named[last] = value.strip().decode("utf-8", "replace")
    row = {column: named.get(name.lower()) for column, name in HEADERS.items()}
    for column in IN_BRACKETS:
        row[column] = row[column] and row[column].removeprefix("<").removesuffix(">")
    return row, int(named.get("content-length", 0))


def _records(source: io.BufferedIOBase, skip: Callable[[int], None], tests: list, with_payload: bool) -> Iterator[dict]:
    while True:
        line = source.readline()
        while line in (b"\r\n", b"\n"):
            line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("a record must start with its version")
        lines = [line]
        while (line := source.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line.rstrip(b"\r\n") + b"\r\n")
        row, length = parse_header(b"".join(lines))
        if not all(t(row) for t in tests):
            skip(length)
            continue
        row |= {"payload_length": None, "payload": None}
        if row["content_type"] and row["content_type"].replace(" ", "").startswith("application/http"):
            head, size = [], 0
            while size < length and (line := source.readline()):
                size += len(line)
                if line in (b"\r\n", b"\n"):
                    break
                head.append(line)
            for line in head:
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length":
                    row["payload_length"] = int(value)
        else:
            size, row["payload_length"] = 0, length
        if with_payload and row["record_type"] != "revisit":
            row["payload"] = source.read(length - size)
            if row["payload_length"] is None:
                row["payload_length"] = len(row["payload"])
        else:
            skip(length - size)
            if row["payload_length"] is None:
                row["payload_length"] = length - size
        yield row


class WarcReader(DataSourceReader):
    """One partition a file; the manifest, where there is one, names the files."""

    def __init__(self, schema: StructType, options: dict):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.arrow = options["path"], to_arrow_schema(schema)
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.pushed.append(f)

    def partitions(self) -> list[InputPartition]:
        system, path = file_system(self.path)
        if system.get_file_info(path).type == arrow_fs.FileType.File:
            return [WarcFile(path)]
        lists = [f.path for f in system.get_file_info(arrow_fs.FileSelector(path)) if f.path.endswith(MANIFEST)]
        if lists:
            names = []
            for one in sorted(lists):
                with system.open_input_stream(one) as source:
                    names += json.loads(source.read())
            return [WarcFile(f"{path}/{name}") for name in names]
        found = system.get_file_info(arrow_fs.FileSelector(path, recursive=True))
        return [WarcFile(f.path) for f in found if f.path.endswith((".warc", ".warc.gz"))]

    def read(self, partition: WarcFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes where there is no file
            return
        system, _ = file_system(self.path)
        zipped = partition.path.endswith(".gz")
        raw = system.open_input_file(partition.path)
        source = gzip.GzipFile(fileobj=raw) if zipped else io.BufferedReader(raw, 1 << 20)
        skip = (lambda n: _drain(source, n)) if zipped else (lambda n: source.seek(n, io.SEEK_CUR))
        held, size = [], 0
        for row in _records(source, skip, [_test(f) for f in self.pushed], self.with_payload):
            held.append(row)
            size += len(row["payload"] or b"") + 200
            if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(held, self.arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, self.arrow)


def _drain(source: io.BufferedIOBase, n: int) -> None:
    while n > 0 and (some := source.read(min(n, 1 << 20))):
        n -= len(some)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def register_warc(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session and let it take filters."""
    ship_package(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISITED) -> DataFrame:
    """WARC rows of web pages: of equal payloads of at least ``least`` bytes, the one with the smallest key is
    the response, the others revisit it.

    Equal payloads are found by digest and length: one aggregate over digests, and only digests
    that occur more than once are joined back. A NULL html is empty, a NULL
    url has no header, a NULL key has the record id ``urn:page:`` alone and ranks after all others, rows that repeat a key
    revisit its record only if their payload repeats in a smaller key, an empty table gives no rows.
    """
    pages = picked(df, page_id=key, url=url, html=html)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select("page_id", "url", payload.alias("payload")).withColumns({
        "digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("bigint")})
    repeated = (
        pages.where(F.col("payload_length") >= least).select("page_id", "digest").groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND first_id IS NOT NULL").drop("_n")
    )
    joined = pages.join(repeated.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    record_id = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        record_id("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(NO_DATE).alias("date"), F.lit(HTTP_RESPONSE).alias("content_type"),
        F.when(again, record_id("first_id")).alias("refers_to"), F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_length", F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str, compression: str = "none", roll_bytes: int = ROLL_BYTES) -> None:
    register_warc(records.sparkSession)
    records.write.format("warc").option("path", path).option("compression", compression).option(
        "rollbytes", str(roll_bytes)).mode("append").save()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under a path; without ``payload`` only headers are decoded."""
    register_warc(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(df: DataFrame, compression: str = "gzip", **options) -> DataFrame:
    """Write the pages to archives in the shared folder, a compressed member for each record, and read them back."""
    spark = df.sparkSession
    folder = new_folder(spark, "warc")
    write_warc(page_records(df, **options), folder, compression)
    return read_warc(spark, folder)
