"""WARC archives: a deduplicating writer and a Python data source that reads them.

The source plans whole files as partitions. It parses a record's headers first;
record types and header values that a filter excludes are skipped without
decoding the payload: by the member's length, which our writer notes in the
gzip extra field, or else by the content length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from .storage import salted_join, scratch_path, stored

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, payload binary"
#: Columns that filters reach before a payload is decoded, with their headers.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
_DATE = "2025-01-01T00:00:00Z"  # archives of the same rows are the same bytes
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 8_000_000


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(uri: str):
    """The file system of a URI and the path there; a bare path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if re.match(r"\w+:", uri) else f"file://{uri}")


def member(data: bytes) -> bytes:
    """One gzip member with its own compressed and plain length in the extra field."""
    deflate = zlib.compressobj(5, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(record_id: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit of ``refers_to`` that keeps only the HTTP headers."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}"]
    lines += [f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', uri)}"] if uri else []
    lines += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}"]
    lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"] if refers_to else []
    lines += [f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, name: str = "warc", least_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, html) as gzip WARC files in the shared folder; returns the stored manifest (path, records).

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with
    the largest page_id is the response, the others are revisits of it. Null
    html is an empty payload, null url has no target. Rows that repeat the
    largest page_id are responses too. Null page_id: a record of an id without
    a number, which is never the response that others refer to unless all are
    null. A task writes one file under a name of its own attempt, and only files
    of tasks that ended are in the manifest, so lost executors leave no trace in
    what is read. Empty input: no files.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, name)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload")).withColumn("size", F.length("payload"))
    counted = rows.groupBy("sha", "size").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("_n"))
    counted = stored(counted.filter("_n > 1"), "payloads")  # a payload of one row has no revisits
    newest = counted.filter(F.col("size") >= least_bytes).select("sha", "size", "newest")
    rows = salted_join(rows, newest, ["sha", "size"], "page_id", "left", counted.select("sha", "size", "_n")).select("page_id", "url", "payload", F.when(F.col("newest") != F.coalesce("page_id", F.col("newest") - 1), F.col("newest")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = None
        n = 0
        for batch in batches:
            for page, url, body, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                if out is None:
                    at = TaskContext.get()
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    path = f"part-{at.partitionId():06d}-{at.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                    out = fs.open_output_stream(f"{base}/{path}", compression=None)
                of = lambda x: f"urn:spanloom:page:{'' if x is None else x}"
                out.write(member(record(of(page), url or "", body.as_py(), None if other is None else of(other))))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([n], pa.int64())], names=["path", "records"])

    return stored(rows.mapInArrow(run, "path string, records long"), f"{name}-manifest")


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Takes equality and membership on header columns; Spark applies the rest."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = set(f.value) if isinstance(f, In) else {f.value}
                name = f.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs as pafs

        fs, base = filesystem(self.options["path"])
        listed = fs.get_file_info(pafs.FileSelector(base, recursive=True)) if fs.get_file_info(base).type == pafs.FileType.Directory else [fs.get_file_info(base)]
        keep = None
        if "manifest" in self.options:
            import pyarrow.dataset as ds

            tables, at = filesystem(self.options["manifest"])
            paths = ds.dataset(at, filesystem=tables, format="parquet", schema=pa.schema([("path", pa.string())])).to_table()["path"].to_pylist()
            keep = {p.rsplit("/", 1)[-1] for p in paths}
        prefix = self.options["path"][: -len(base)] if self.options["path"].endswith(base) else ""
        files = sorted((f.path, f.size) for f in listed if re.search(r"\.warc(\.gz)?$", f.path) and (keep is None or f.path.rsplit("/", 1)[-1] in keep))
        most = int(self.options.get("partitionbytes", 16_000_000))
        parts, held = [[]], 0
        for path, size in files:
            if parts[-1] and held + size > most:
                parts.append([])
                held = 0
            parts[-1].append(prefix + path)
            held += size
        return [Files(p) for p in parts if p] or [Files([])]

    def read(self, partition):
        rows, held = [], 0
        payloads = self.options.get("payload", "true").lower() != "false"
        for path in partition.paths:
            fs, local = filesystem(path)
            with fs.open_input_file(local) as f:
                for row in records(f, self.wanted, payloads, path.endswith(".gz")):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > _BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; options: path, manifest (a Parquet table whose column path names the files that count), payload (false: not decoded), partitionbytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))


class _Stream:
    """Bytes of a plain file or of a run of gzip members, inflated as far as they are asked for."""

    def __init__(self, f, zipped: bool):
        self.f, self.zipped, self.plain, self.raw = f, zipped, bytearray(), b""
        self.inflate = zlib.decompressobj(31) if zipped else None
        self.fresh = True  # at a member's start

    def more(self) -> bool:
        data = self.raw or self.f.read(65536)
        self.raw = b""
        if not data:
            return False
        if not self.zipped:
            self.plain += data
            return True
        self.fresh = False
        self.plain += self.inflate.decompress(data, 65536)
        if self.inflate.eof:
            self.raw, self.inflate, self.fresh = self.inflate.unused_data, zlib.decompressobj(31), True
        else:
            self.raw = self.inflate.unconsumed_tail
        return True

    def member(self) -> tuple[int, int, bytes] | None:
        """Start, length and read-ahead of the member that begins here, if our writer's extra field says how long it is."""
        while self.zipped and not self.plain and not self.fresh and self.more():
            pass
        if not self.zipped or self.plain or not self.fresh:
            return None
        start = self.f.tell() - len(self.raw)
        while len(self.raw) < 24 and (data := self.f.read(65536)):
            self.raw += data
        raw = self.raw
        return (start, struct.unpack("<I", raw[16:20])[0], raw) if len(raw) >= 24 and raw[3:4] == b"\x04" and raw[12:14] == b"sl" else None

    def skip(self, at: tuple[int, int, bytes]) -> None:
        """On to the end of the member that began ``at``, without inflating it."""
        start, length, ahead = at
        self.plain.clear()
        self.inflate, self.fresh, self.raw = zlib.decompressobj(31), True, b""
        if length <= len(ahead) and self.f.tell() == start + len(ahead):
            self.raw = ahead[length:]
        else:
            self.f.seek(start + length)

    def upto(self, mark: bytes) -> bytes | None:
        at = 0
        while (found := self.plain.find(mark, at)) < 0:
            at = max(0, len(self.plain) - len(mark))
            if not self.more():
                return None
        out = bytes(self.plain[: found + len(mark)])
        del self.plain[: found + len(mark)]
        return out

    def lead(self, n: int) -> bytes:
        """Of the next n bytes those up to and with the first empty line; all if there is none."""
        at = 0
        while (found := self.plain.find(b"\r\n\r\n", at, n)) < 0 and len(self.plain) < n:
            at = max(0, len(self.plain) - 4)
            if not self.more():
                raise EOFError("the archive ends within a record")
        return self.take(n if found < 0 else found + 4)

    def take(self, n: int, keep: bool = True) -> bytes:
        """The next n bytes; without ``keep`` they are passed over as they come."""
        if not keep:
            while n > len(self.plain):
                n -= len(self.plain)
                self.plain.clear()
                if not self.more():
                    raise EOFError("the archive ends within a record")
            del self.plain[:n]
            return b""
        while n > len(self.plain):
            if not self.more():
                raise EOFError("the archive ends within a record")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out


def fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts with white space goes on with the one before."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def records(f, wanted: dict[str, set], payloads: bool, zipped: bool) -> Iterator[tuple]:
    """The records of an open archive that ``wanted`` admits, as rows of SCHEMA."""
    stream = _Stream(f, zipped)
    while True:
        member_at = stream.member()
        head = stream.upto(b"\r\n\r\n")
        if head is None:
            return
        h = fields(head.lstrip(b"\r\n"))
        row = {c: h.get(name.lower()) for c, name in HEADERS.items()}
        for c in ("record_id", "refers_to"):
            row[c] = row[c].strip("<>") if row[c] else row[c]
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        left = int(h.get("content-length", 0))
        http = h.get("content-type", "").startswith("application/http")
        whole = row["record_type"] != "revisit"
        if any(row[c] not in values for c, values in wanted.items()):
            found = None
        else:
            lead = stream.lead(left) if http else b""
            left -= len(lead)
            many = left if whole else int(fields(lead)["content-length"]) if b"ontent-" in lead else None
            body = stream.take(left) if payloads and whole else None
            left -= len(body or b"")
            if body is not None and row["payload_digest"] and sha1_base32(body) != row["payload_digest"]:
                raise ValueError(f"{row['record_id']}: the payload doesn't have its digest")
            found = (*row.values(), many, body)
        if left and member_at:
            stream.skip(member_at)
        else:
            stream.take(left + 4, keep=False)
        if found:
            yield found


def read_archives(spark: SparkSession, manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the files that a stored manifest lists, a row for each; empty without files.

    A null page was written as an empty payload and is read as one; a record
    without a refers-to header has a null there.

    Filters on header columns reach the source. For this the session's
    ``spark.sql.python.filterPushdown.enabled`` is switched on.
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    first = manifest.select("path").first()
    if first is None:
        return spark.createDataFrame([], SCHEMA)
    table = manifest.inputFiles()[0].rsplit("/", 1)[0]
    return spark.read.format("warc").option("path", first["path"].rsplit("/", 1)[0]).option("manifest", table).option("payload", str(payload).lower()).load()
