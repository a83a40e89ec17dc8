"""WARC archives as a Spark data source, and pages archived with equal payloads stored once.

``register(spark)`` makes the format "warc" known. A read plans partitions from file sizes, reads the header
of each record first, applies the predicates that Spark pushes down (record type and other header columns),
and steps over the payload of every record that they reject, or of all if no payload column is asked for.
Push-down is an option, off unless asked for: in Spark 4.1 all scans of one loaded frame share the predicates
planned last, so a frame that a query uses twice would lose rows. ``records_of`` asks for it, on a fresh frame.
Archives may be plain or compressed record by record; the writer's compressed members tell their length
(extra field "sl"), so stepping over one costs no inflation. Members of other writers are inflated to find
their end, and their files are one partition each.

A write gives each task its own files and names them in a manifest when the job commits, so files of lost or
repeated tasks are never read. A folder without a manifest is read whole. Files are opened with pyarrow's
file systems (file, hdfs, s3, gs, abfss), by the executors themselves.

Columns (a read may ask for any of them): file, offset, type, record_id, uri, date, digest, refers_to,
block_bytes, payload_bytes, headers, payload. ``payload`` is the body of an HTTP block, else the whole block;
transfer encodings inside it are left as they are. A damaged record ends the read with its file and place.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
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

from buyerlens.llm.common import new_path, ship_package, written

SCHEMA = (
    "file string, offset long, type string, record_id string, uri string, date string, digest string, refers_to string, "
    "block_bytes long, payload_bytes long, headers map<string,string>, payload binary"
)
KINDS = {
    "file": pa.string(),
    "offset": pa.int64(),
    "type": pa.string(),
    "record_id": pa.string(),
    "uri": pa.string(),
    "date": pa.string(),
    "digest": pa.string(),
    "refers_to": pa.string(),
    "block_bytes": pa.int64(),
    "payload_bytes": pa.int64(),
    "headers": pa.map_(pa.string(), pa.string()),
    "payload": pa.binary(),
}
#: Fixed names of the format.
HEADERS = {
    "type": "warc-type",
    "record_id": "warc-record-id",
    "uri": "warc-target-uri",
    "date": "warc-date",
    "digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
READ = 1 << 20  # bytes fetched at a time
HEAD = 1 << 24  # longest header
SPLIT = 32 << 20  # bytes of a partition
ROLL = 256 << 20  # bytes after which a task begins a new file
BATCH = 8 << 20  # bytes of payload in a batch


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


# Reading


class Bytes:
    """Random access to a file through one buffer."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()
        self.start, self.data = 0, b""

    def at(self, place: int, n: int) -> bytes:
        """Up to n bytes from a place."""
        if place < self.start or place + n > self.start + len(self.data):
            if place >= self.size:
                return b""
            self.file.seek(place)
            self.start, self.data = place, self.file.read(max(n, READ))
        return self.data[place - self.start : place - self.start + n]


class Damaged(ValueError):
    pass


def _fields(lines: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


class Record:
    """A record whose header is read and whose block is read on demand."""

    def __init__(self, headers: dict[str, str], place: int):
        self.headers, self.place = headers, place
        self.block_bytes = int(headers["content-length"])

    def block(self, start: int, n: int) -> bytes:
        raise NotImplementedError

    def http(self) -> tuple[int, dict[str, str]]:
        """Where the payload begins in the block, and the HTTP header fields."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return 0, {}
        n = 4096
        while True:
            head = self.block(0, min(n, self.block_bytes))
            end = head.find(b"\r\n\r\n")
            if end >= 0:
                return end + 4, _fields(head[:end])
            if n >= min(self.block_bytes, HEAD):
                return self.block_bytes, _fields(head)  # headers only
            n *= 4

    def value(self, column: str):
        if column in HEADERS:
            text = self.headers.get(HEADERS[column])
            return text[1:-1] if text and column in ("record_id", "refers_to") and text[0] == "<" else text
        if column == "block_bytes":
            return self.block_bytes
        if column == "offset":
            return self.place
        if column == "headers":
            return list(self.headers.items())
        start, http = self.http()
        if column == "payload_bytes":
            if self.headers.get("warc-type") == "revisit":  # the full payload, which this record leaves out
                known = http.get("content-length", "")
                return int(known) if known.isdigit() else None
            return self.block_bytes - start
        return self.block(start, self.block_bytes - start)


class PlainRecord(Record):
    def __init__(self, data: Bytes, place: int):
        n = 4096
        while (end := (head := data.at(place, n)).find(b"\r\n\r\n")) < 0:
            if len(head) < n or n >= HEAD:
                raise Damaged("no end of the header")
            n *= 4
        if not head.startswith(b"WARC/"):
            raise Damaged("no record begins here")
        super().__init__(_fields(head[:end]), place)
        self.data, self.start = data, place + end + 4
        self.end = self.start + self.block_bytes + 4
        if self.start + self.block_bytes > data.size:
            raise Damaged("the record is cut off")

    def block(self, start: int, n: int) -> bytes:
        return self.data.at(self.start + start, n)


class PackedRecord(Record):
    """A record in a gzip member of its own."""

    def __init__(self, data: Bytes, place: int):
        self.data, self.begin = data, place
        fixed = data.at(place, 10)
        if fixed[:3] != b"\x1f\x8b\x08":
            raise Damaged("no member begins here")
        self.end = None
        if fixed[3] & 4:
            n = struct.unpack("<H", data.at(place + 10, 2))[0]
            extra = data.at(place + 12, n)
            if extra[:4] == b"sl\x08\x00":
                self.end = place + struct.unpack("<I", extra[4:8])[0]
                if self.end > data.size:
                    raise Damaged("the member is cut off")
        n = 1024
        while (end := (head := self._inflated(n)).find(b"\r\n\r\n")) < 0:
            if len(head) < n or n >= HEAD:
                raise Damaged("no end of the header")
            n *= 4
        if not head.startswith(b"WARC/"):
            raise Damaged("no record begins here")
        super().__init__(_fields(head[:end]), place)
        self.start = end + 4
        self.whole: bytes | None = None
        if self.end is None:
            self._inflated(None)

    def _inflated(self, n: int | None) -> bytes:
        """The first n bytes of the member; with None all of it is passed over, which finds its end."""
        z, place, out = zlib.decompressobj(31), self.begin, []
        while not z.eof and (n is None or n > 0):
            chunk = z.unconsumed_tail or self.data.at(place, 4096 if n is not None and n <= 4096 else READ)
            if not z.unconsumed_tail:
                place += len(chunk)
            if not chunk:
                raise Damaged("the member is cut off")
            got = z.decompress(chunk, n or READ)
            if n is not None:
                out.append(got)
                n -= len(got)
        if n is None:
            self.end = place - len(z.unused_data)
        return b"".join(out)

    def block(self, start: int, n: int) -> bytes:
        if self.whole is None or len(self.whole) < start + n:
            self.whole = self._inflated(self.start + start + n)[self.start :]
        if len(self.whole) < start + n:
            raise Damaged("the record is cut off")
        return self.whole[start : start + n]


def records(data: Bytes, packed: bool, start: int, end: int) -> Iterator[Record]:
    """The records that begin in [start, end)."""
    place = start
    while place < min(end, data.size):
        record = PackedRecord(data, place) if packed else PlainRecord(data, place)
        yield record
        place = record.end


def test_of(f: Filter):
    """A test of one header value, or None if the filter can't be decided from headers."""
    if isinstance(f, Not):
        inner = f.child
        test = None if isinstance(inner, (Not, IsNull, IsNotNull, EqualNullSafe)) else test_of(inner)
        return test and (test[0], lambda v: v is not None and not test[1](v))
    if len(f.attribute) != 1 or f.attribute[0] not in (*HEADERS, "block_bytes"):
        return None
    x = getattr(f, "value", None)
    tests = {
        EqualTo: lambda v: v is not None and v == x,
        EqualNullSafe: lambda v: v == x,
        GreaterThan: lambda v: v is not None and v > x,
        GreaterThanOrEqual: lambda v: v is not None and v >= x,
        LessThan: lambda v: v is not None and v < x,
        LessThanOrEqual: lambda v: v is not None and v <= x,
        In: lambda v: v is not None and v in x,
        IsNull: lambda v: v is None,
        IsNotNull: lambda v: v is not None,
        StringStartsWith: lambda v: v is not None and v.startswith(x),
        StringEndsWith: lambda v: v is not None and v.endswith(x),
        StringContains: lambda v: v is not None and x in v,
    }
    test = tests.get(type(f))
    return test and (f.attribute[0], test)


@dataclass
class Range(InputPartition):
    """Pieces of files (path, first byte, end) that one task reads."""

    pieces: list[tuple[str, int, int]]


class Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split: int):
        self.path, self.columns, self.split = path, columns, split
        self.filters: list[Filter] = []

    def partitions(self) -> list[Range]:
        fs, root = file_system(self.path)
        pieces = []
        if fs.get_file_info(root).type == pafs.FileType.File:
            pieces = [(root, 0, 1 << 62)]
        else:
            found = {x.path: x for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.is_file}
            lists = [p for p in found if os.path.basename(p).startswith("_manifest-")]
            if lists:
                for p in sorted(lists):
                    with fs.open_input_stream(p) as f:
                        for line in f.read().decode().splitlines():
                            x = json.loads(line)
                            marks = [*x["marks"], x["size"]]
                            pieces += [(f"{root}/{x['file']}", a, b) for a, b in zip(marks, marks[1:], strict=False)]
            else:
                pieces = [(p, 0, found[p].size) for p in sorted(found) if p.endswith((".warc", ".warc.gz"))]
        out: list[Range] = []
        room = 0
        for p, a, b in pieces:
            if room < b - a:
                out.append(Range([]))
                room = self.split
            out[-1].pieces.append((p, a, b))
            room -= b - a
        return out or [Range([])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        schema = pa.schema([(c, KINDS[c]) for c in self.columns])
        tests = [t for t in map(test_of, self.filters) if t]
        rows: list[list] = [[] for _ in self.columns]
        size = n = 0

        def batch():
            arrays = [pa.array(v, f.type) for v, f in zip(rows, schema, strict=True)]
            return pa.RecordBatch.from_struct_array(pa.StructArray.from_arrays(arrays, fields=list(schema))) if arrays else None

        for path, start, end in partition.pieces:
            with fs.open_input_file(path) as file:
                place = start
                try:
                    for record in records(Bytes(file), path.endswith(".gz"), start, end):
                        place = record.end
                        if not all(test(record.value(c)) for c, test in tests):
                            continue
                        for values, c in zip(rows, self.columns, strict=True):
                            values.append(os.path.basename(path) if c == "file" else record.value(c))
                        n += 1
                        size += 256 + (record.block_bytes if "payload" in self.columns else 0)
                        if size >= BATCH:
                            yield batch()
                            rows, size, n = [[] for _ in self.columns], 0, 0
                except (Damaged, KeyError, zlib.error) as e:
                    raise Damaged(f"{path}, after byte {place}: {e}") from e
        if n:
            yield batch()


class PushingReader(Reader):
    """A reader that takes over predicates. Spark tests the rows again, which costs little."""

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        self.filters = [f for f in filters if test_of(f) is not None]
        return filters


# Writing


@dataclass
class Files(WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


def one_line(value: str) -> str:
    """A header value without control characters, which are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(row: dict, date: str) -> bytes:
    """One record; a revisit keeps the HTTP header but not the payload."""
    payload = row.get("payload") or b""
    kind = row.get("type") or "response"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{one_line(row['record_id'])}>"]
    lines.append(f"WARC-Date: {row.get('date') or date}")
    if row.get("uri") is not None:
        lines.append(f"WARC-Target-URI: {one_line(row['uri'])}")
    if row.get("digest") is not None:
        lines.append(f"WARC-Payload-Digest: {one_line(row['digest'])}")
    if row.get("refers_to") is not None:
        lines.append(f"WARC-Refers-To: <{one_line(row['refers_to'])}>")
    if kind in ("response", "revisit"):
        size = len(payload) if row.get("payload_bytes") is None else row["payload_bytes"]
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        lines.append("Content-Type: application/http; msgtype=response")
        if kind == "revisit":
            lines.append(f"WARC-Profile: {SAME}")
            payload = b""
        payload = http + payload
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field holds its own length and that of its content."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    total = 24 + len(body) + 8
    extra = b"sl\x08\x00" + struct.pack("<II", total, len(data) & 0xFFFFFFFF)
    if total >> 32:
        raise ValueError("a record of 4 GB or more can't be compressed")
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, packed: bool, date: str, split: int, roll: int, level: int, overwrite: bool):
        self.path, self.packed, self.date, self.split = path, packed, date, split
        self.roll, self.level, self.overwrite = roll, level, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        wrap = (lambda x: member(x, self.level)) if self.packed else (lambda x: x)
        files: list[dict] = []
        out = None

        def begun():
            name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.packed else "")
            files.append({"file": name, "size": 0, "marks": [0]})
            return fs.open_output_stream(f"{root}/{name}", compression=None)

        def put(data: bytes) -> None:
            here = files[-1]
            if here["size"] - here["marks"][-1] >= self.split:
                here["marks"].append(here["size"])
            out.write(data)
            here["size"] += len(data)

        for batch in iterator:
            names = batch.schema.names
            for i in range(batch.num_rows):
                if out is None:
                    out = begun()
                    about = f"<urn:uuid:{uuid.uuid4()}>"
                    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {about}\r\nWARC-Date: {self.date}\r\n"
                    put(wrap((head + "Content-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n").encode()))
                put(wrap(record_bytes({c: batch.column(k)[i].as_py() for k, c in enumerate(names)}, self.date)))
                if files[-1]["size"] >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Files(files)

    def commit(self, messages: list[Files | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        old = fs.get_file_info(pafs.FileSelector(root)) if self.overwrite else []
        kept = {x["file"] for m in messages if m for x in m.files}
        lines = [json.dumps(x) for m in messages if m for x in m.files]
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}", compression=None) as f:
            f.write("\n".join(lines).encode())
        for x in old:
            if x.is_file and x.base_name not in kept and x.base_name.startswith(("_manifest-", "part-")):
                fs.delete_file(x.path)

    def abort(self, messages: list[Files | None]) -> None:
        fs, root = file_system(self.path)
        for name in [x["file"] for m in messages if m for x in m.files]:
            fs.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """Options: path, pushdown, split (bytes of a partition), compression (gzip or none), level, roll, date."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        unknown = set(schema.names) - set(KINDS)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        kind = PushingReader if self.options.get("pushdown", "false") == "true" else Reader
        return kind(self.options["path"], schema.names, int(self.options.get("split", SPLIT)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        o = self.options
        packed = o.get("compression", "gzip") == "gzip"
        return Writer(
            o["path"], packed, o.get("date", EPOCH), int(o.get("split", SPLIT)), int(o.get("roll", ROLL)), int(o.get("level", 6)), overwrite
        )


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark push predicates to Python sources (a setting of the session)."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records_of(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records below ``path``, loaded anew, with predicates pushed to the source.

    Use such a frame for one query: the scans of one loaded frame share the predicates that were planned last.
    """
    kinds = dict(part.split() for part in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    register(spark)
    return spark.read.format("warc").schema(schema).option("pushdown", "true").load(path)


# Pages


def with_roles(pages: DataFrame, least: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The columns of a record for each page: type, record_id, uri, digest, refers_to, payload_bytes, payload.

    Of pages with equal payloads of at least ``least`` bytes those with the smallest id are responses, the
    others revisit it. Null payloads are empty; a null id is larger than any other and is never referred to,
    so pages without any id among them are all responses. Rows that repeat the smallest id are responses
    too. Other columns are ignored. Only digests, lengths and ids are grouped; payloads move only if the list
    of repeated payloads is too long to broadcast.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("string").alias("id"),
        F.col(f"`{page_id}`").alias("key"),
        F.col(f"`{url}`").cast("string").alias("uri"),
        F.encode(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumns({"sha": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    repeated = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
        .select("sha", "first")
    )
    rows = rows.join(written(repeated, "repeated-payloads"), "sha", "left")
    again = F.col("first").isNotNull() & ~F.coalesce(F.col("key") == F.col("first"), F.lit(False))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("type"),
        name(F.col("id")).alias("record_id"),
        "uri",
        F.concat(F.lit("sha256:"), "sha").alias("digest"),
        F.when(again, name(F.col("first"))).alias("refers_to"),
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def archived(pages: DataFrame, path: str | None = None, least: int = 100, **options) -> DataFrame:
    """Write a record for each page below ``path`` and return the records read back: page_id (as text),
    type, refers_to, uri, payload_bytes and payload_digest, both of the full payload.

    Length and digest of a response are taken from the payload read back, those of a revisit from its
    headers. An empty table gives an archive without records.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or new_path(spark, "warc")
    with_roles(pages, least, **options).write.format("warc").mode("append").save(path)
    found = records_of(spark, path, ["type", "record_id", "uri", "digest", "refers_to", "payload_bytes", "payload"])
    found = found.filter(F.col("type").isin("response", "revisit"))
    own = F.col("type") == "response"
    page = lambda c: F.nullif(F.regexp_replace(c, "^urn:page:", ""), F.lit("null"))
    return found.select(
        page(F.col("record_id")).alias("page_id"),
        "type",
        page(F.col("refers_to")).alias("refers_to"),
        "uri",
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.regexp_replace("digest", "^sha256:", "")).alias("payload_digest"),
    )
