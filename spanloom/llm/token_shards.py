"""Token ids in training order: fixed-stride binary shards.

Documents are tokenised to sequences of one length. A keyed Feistel permutation
with cycle-walking gives each sequence a global slot; slots are dealt by range
to shards, files of records of one size. A reader that knows a slot knows file
and offset, so it can go on anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import SEPARATOR_ID, default_tokenizer, encoder
from .storage import scratch_path, stored
from .warc import filesystem

LENGTH = 2048
#: Records of a shard: 16 MB of 16-bit ids.
SHARD_RECORDS = 4096
ROUNDS = 4
#: Rows of a part on average; past so many parts, parts grow with the table.
PART_ROWS, MANY_PARTS = 4096, 16_384

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """The slot of each index under a keyed permutation of 0..size-1.

    A balanced Feistel network permutes the smallest even number of bits that
    holds ``size``; a value outside walks on along its cycle until it is inside.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * _M2 + np.array([key & (1 << 64) - 1], np.uint64))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        return left << shift | right

    out = once(index.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def token_sequences(docs: DataFrame, tokenizer: tuple[str, str] | None = None, length: int = LENGTH) -> DataFrame:
    """Sequences of ``length`` ids from the documents of each part in turn, stored.

    Columns: part, number (the sequence's in its part), ids binary (16-bit
    little-endian), segments array of (doc_id, start, length, at). A document's
    part and its place there come from hashes of its id and text, and the number
    of parts from that of the rows: the same documents make the same sequences,
    however they are stored or read. Each document ends with the separator; a
    part's last sequence is filled up with separators that belong to no segment.
    Null or empty text: the separator alone. Repeated rows and null doc_ids are
    kept. Further columns are dropped.
    """
    path, pattern = tokenizer or default_tokenizer()
    rows = docs.count()
    parts = max(1, min(-(-rows // PART_ROWS), MANY_PARTS + rows // (16 * PART_ROWS)))
    part = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(parts)).cast("int")
    docs = docs.select("doc_id", "text", part.alias("part"), F.xxhash64("doc_id", "text").alias("h"))
    docs = docs.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "h", "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"part int, number long, ids binary, segments array<struct<doc_id:{kind},start:long,length:int,at:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        if enc.max_token_value >= 1 << 16:
            raise ValueError("16-bit ids don't hold this vocabulary")
        part, number, rows = None, 0, []
        held = np.full(length, SEPARATOR_ID, "<u2")
        at, segments = 0, []

        def flush(kind):
            ids, segs = [r[1] for r in rows], [s for r in rows for s in r[2]]
            ends = np.cumsum([0, *(len(r[2]) for r in rows)])
            struct = pa.StructArray.from_arrays([pa.array([s[0] for s in segs], kind), pa.array([s[1] for s in segs], pa.int64()), pa.array([s[2] for s in segs], pa.int32()), pa.array([s[3] for s in segs], pa.int32())], names=["doc_id", "start", "length", "at"])
            out = pa.RecordBatch.from_arrays([pa.array([r[3] for r in rows], pa.int32()), pa.array([r[0] for r in rows], pa.int64()), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)], names=["part", "number", "ids", "segments"])
            rows.clear()
            return out

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for doc, text, mine in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if mine != part:
                    if at:
                        held[at:] = SEPARATOR_ID
                        rows.append((number, held.tobytes(), segments, part))
                    part, number, at, segments = mine, 0, 0, []
                ids = np.array([*enc.encode(text.as_py() or "", allowed_special="all"), SEPARATOR_ID], "<u2")
                start = 0
                while start < len(ids):
                    n = min(length - at, len(ids) - start)
                    held[at : at + n] = ids[start : start + n]
                    segments.append((doc, start, n, at))
                    start, at = start + n, at + n
                    if at == length:
                        rows.append((number, held.tobytes(), segments, part))
                        number, at, segments = number + 1, 0, []
                        if len(rows) >= 1024:
                            yield flush(id_type)
        if at:
            held[at:] = SEPARATOR_ID
            rows.append((number, held.tobytes(), segments, part))
        if rows:
            yield flush(id_type)

    return stored(docs.select("doc_id", "text", "part").mapInArrow(run, schema), "sequences", "zstd")


def indexed(sequences: DataFrame) -> tuple[DataFrame, int]:
    """The sequences with a dense index long, and how many there are; a part's rows follow those of the parts before."""
    counts = sequences.groupBy("part").agg(F.count("*").alias("n"))
    before = stored(counts.select("part", "n", (F.expr("sum(n) over (order by part)") - F.col("n")).alias("before")), "parts")
    size = before.agg(F.sum("n")).first()[0] or 0
    return sequences.join(before.select("part", "before"), "part").withColumn("index", F.col("before") + F.col("number")), size


def _slots(size: int, key: int, pressed: bool):
    """(index, value) to (slot, value); ids are compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            value = pa.array([press.compress(v.as_buffer()) for v in batch.column(1)], pa.binary()) if pressed else batch.column(1)
            yield pa.RecordBatch.from_arrays([pa.array(permuted(batch.column(0).to_numpy(), size, key)), value], names=["slot", "value"])

    return run


def write_shards(sequences: DataFrame, key: int = 1, shard_records: int = SHARD_RECORDS, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write sequences in the order of their slots; returns the stored manifest and the stored segments.

    manifest: shard, path, records, stride (bytes). segments: doc_id, start,
    length, at, slot, shard. A shard is written under a name of the attempt and
    then renamed, and one that is there already with its full size is kept, so a
    job that starts anew with the same ``folder`` goes on where it was. Empty
    input: no shards. Segments of repeated rows and of null doc_ids are kept.
    """
    spark = sequences.sparkSession
    folder = folder or scratch_path(spark, "shards")
    rows, size = indexed(sequences)
    first = sequences.select("ids").first()
    stride = len(first["ids"]) if first else 0
    kind = sequences.schema["segments"].dataType.simpleString()
    shard = F.floor(F.col("slot") / shard_records)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        fs = base = now = out = temp = None
        done: list[list[int]] = []

        def close():
            if out is not None:
                out.close()
                fs.move(temp, f"{base}/shard-{now:08d}.bin")

        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if s != now:
                    close()
                    if fs is None:
                        fs, base = filesystem(folder)
                        fs.create_dir(base, recursive=True)
                    now = s
                    done.append([s, 0])
                    there = fs.get_file_info(f"{base}/shard-{s:08d}.bin")
                    temp = f"{base}/.shard-{s:08d}-{TaskContext.get().taskAttemptId()}"
                    full = stride * min(shard_records, size - s * shard_records)
                    out = None if there.is_file and there.size == full else fs.open_output_stream(temp, compression=None)
                if out is not None:
                    out.write(unpress.decompress(data.as_buffer()))
                done[-1][1] += 1
        close()
        if done:
            paths = [f"{folder}/shard-{s:08d}.bin" for s, _ in done]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in done]), pa.array(paths), pa.array([n for _, n in done]), pa.array([stride] * len(done))], names=["shard", "path", "records", "stride"])

    dealt = rows.select("index", "ids").mapInArrow(_slots(size, key, True), "slot long, value binary").withColumn("shard", shard)
    ordered = dealt.repartitionById(max(1, -(-size // shard_records)), F.col("shard").cast("int")).sortWithinPartitions("shard", "slot").select("shard", "value")
    manifest = stored(ordered.mapInArrow(run, "shard long, path string, records long, stride long"), "shard-manifest")
    placed = rows.select("index", "segments").mapInArrow(_slots(size, key, False), f"slot long, value {kind}")
    return manifest, stored(placed.select(F.explode("value").alias("s"), "slot", shard.alias("shard")).select("s.*", "slot", "shard"), "segments")


def read_slots(manifest: DataFrame, start: int = 0, stop: int | None = None, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(slot, ids binary) of the slots from ``start`` up to ``stop``: each shard's range is read in one go from its offset."""
    wanted = manifest.filter(F.col("shard") >= start // shard_records)
    if stop is not None:
        wanted = wanted.filter(F.col("shard") * shard_records < stop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, records, stride in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low, high = max(0, start - shard * shard_records), records if stop is None else min(records, stop - shard * shard_records)
                fs, local = filesystem(path)
                with fs.open_input_file(local) as f:
                    f.seek(low * stride)
                    for at in range(low, high, 1024):
                        n = min(1024, high - at)
                        data = f.read(n * stride)
                        ids = [data[i * stride : (i + 1) * stride] for i in range(n)]
                        yield pa.RecordBatch.from_arrays([pa.array(range(shard * shard_records + at, shard * shard_records + at + n), pa.int64()), pa.array(ids, pa.binary())], names=["slot", "ids"])

    return wanted.select("shard", "path", "records", "stride").mapInArrow(run, "slot long, ids binary")


def read_segments(manifest: DataFrame, segments: DataFrame, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """The segments with n_bytes read and ids_crc32 of what their shards hold, read shard by shard in order of their slots.

    A row for each segment, those of repeated rows and of null doc_ids too; no
    shards, no rows.
    """
    kind = segments.schema["doc_id"].dataType.simpleString()
    rows = segments.join(manifest.select("shard", "path", "stride"), "shard").select("doc_id", "start", "length", "at", "slot", "shard", "path", "stride")
    tasks = max(1, manifest.count())
    ordered = rows.repartitionById(tasks, F.col("shard").cast("int")).sortWithinPartitions("shard", "slot", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        name = f = record = None
        last = -1
        for batch in batches:
            crc = []
            for length, at, slot, path, stride in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 6, 7)), strict=True):
                if path != name:
                    fs, local = filesystem(path)
                    name, f, last = path, fs.open_input_file(local), -1
                if slot != last:
                    f.seek(slot % shard_records * stride)
                    record, last = f.read(stride), slot
                crc.append(zlib.crc32(record[2 * at : 2 * (at + length)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(6)), pa.array(crc, pa.int64())], names=["doc_id", "start", "length", "at", "slot", "shard", "ids_crc32"])

    return ordered.mapInArrow(run, f"doc_id {kind}, start long, length int, at int, slot long, shard long, ids_crc32 long")
