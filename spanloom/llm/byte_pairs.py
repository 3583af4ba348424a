"""Byte-level BPE encoding and decoding over the distinct words of a corpus.

Texts are cut to pre-tokens where they lie. A block of documents keeps each of
its words once, and its documents as the words' numbers in order of position.
The words of all blocks are shuffled, each distinct one is encoded once, its ids
are joined with the token-byte table to decode them, and what comes out goes
back with its places and is joined with the blocks, which put their documents
together by position.
"""

from __future__ import annotations

import base64
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial
from itertools import count, islice
from operator import methodcaller
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import scratch_path

#: Code points of a block's texts; a longer text is a block of its own.
BLOCK_CHARS = 24_000_000
#: Texts over this length are cut match by match, without a list of all matches.
LONG_TEXT = 4_000_000
#: Shares of words for each shuffle partition, and codes that are put together at a time.
SHARES, CODES_AT_ONCE = 8, 1 << 18
#: The token-byte table is broadcast up to so many tokens; a vocabulary over it is an error.
MAX_TOKENS = 1 << 20

_ENCODERS: dict[str, object] = {}


def default_ranks() -> tuple[str, str]:
    """Path of the public multilingual ranks, and the pattern of pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def encoder(path: str, pattern: str):
    if path not in _ENCODERS:
        import tiktoken

        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})
    return _ENCODERS[path]


def _ranges(points: list[int]) -> str:
    out, start = [], None
    for i, c in enumerate(points):
        start = c if start is None else start
        if i + 1 == len(points) or points[i + 1] != c + 1:
            out.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return "".join(out)


@cache
def split_patterns(pattern: str) -> tuple[str, str | None]:
    """The pattern with letters and numbers as ``tiktoken`` has them, and a pattern of the characters that ``regex`` takes for other ones.

    The two libraries follow different versions of Unicode. Characters whose
    class changed between the standard library's version and ``regex``'s are
    tried: after a letter, ``tiktoken`` makes one piece of it or two.
    """
    import regex
    import tiktoken

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    exact, odd = pattern, []
    for kind, before in (("L", "a"), ("N", "1")):
        theirs = set(regex.findall(rf"\p{{{kind}}}", everything))
        tried = [c for c in everything if (c in theirs) != (unicodedata.category(c)[0] == kind)]
        ranks = {bytes([i]): i for i in range(256)}
        for c in tried:
            ranks[(before + c).encode()] = len(ranks)
        probe = tiktoken.Encoding("probe", pat_str=r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+", mergeable_ranks=ranks, special_tokens={})
        inside = {c for c in tried if len(probe.encode_ordinary(before + c)) == 1}
        minus = sorted(ord(c) for c in tried if c in theirs and c not in inside)
        plus = sorted(ord(c) for c in tried if c not in theirs and c in inside)
        name = rf"\p{{{kind}}}"
        if minus:
            exact = exact.replace(name, rf"[{name}--[{_ranges(minus)}]]")
        if plus:
            exact = exact.replace(name, rf"{name}{_ranges(plus)}") if not minus else exact.replace(rf"--[{_ranges(minus)}]]", rf"--[{_ranges(minus)}]||[{_ranges(plus)}]]")
        odd += [*minus, *plus]
    return exact, f"[{_ranges(sorted(odd))}]" if odd else None


def _packed(arrays: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Whole numbers under 2**32, byte plane by byte plane, and a tail of bytes, compressed."""
    parts = [np.ascontiguousarray(np.asarray(a, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays]
    raw = b"".join([np.array([len(arrays), *map(len, arrays), len(tail)], "<u8").tobytes(), *parts, tail])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 4).compress(raw, asbytes=True)


def _unpacked(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    many = int(np.frombuffer(raw, "<u8", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<u8", many, 8).astype(int), 8 * (many + 2), []
    for n in sizes:
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel())
        at += 4 * n
    return out, np.frombuffer(raw, np.uint8, len(raw) - at, at)


def word_blocks(docs: DataFrame, pattern: str) -> DataFrame:
    """Blocks of documents as words and their places, stored.

    Two kinds of rows: (block, doc_ids, codes) has a block's documents, the
    number of words of each and, in order of position, the words' numbers;
    (block, share, words) has those of its words, with their numbers, that a
    hash puts into a share. Frequent words have the small numbers. The table is
    bucketed by block, so codes needn't be shuffled to meet a block's words.
    Null text: no words. Repeated rows and null doc_ids are kept.
    """
    exact, odd = split_patterns(pattern)
    kind = docs.schema["doc_id"].dataType
    fields = [("block", T.LongType()), ("doc_ids", T.ArrayType(kind)), ("codes", T.BinaryType()), ("share", T.IntegerType()), ("words", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = SHARES * partitions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        fast, slow = regex.compile(pattern), regex.compile(exact, flags=regex.V1)
        strange = regex.compile(odd) if odd else None
        number = count(TaskContext.get().partitionId() << 32)

        def codes_of(text: str, find, code) -> np.ndarray:
            if len(text) > LONG_TEXT:
                return np.fromiter(map(code, map(methodcaller("group"), find.finditer(text))), np.uint32)
            words = find.findall(text)
            return np.fromiter(map(code, words), np.uint32, len(words))

        def flush(ids: list, codes: list[np.ndarray], index: dict[str, int]) -> pa.RecordBatch:
            sizes, flat = np.array([len(c) for c in codes]), np.concatenate(codes)
            codes.clear()  # a task has little memory beside the block's
            raw = [w.encode() for w in index]
            index.clear()
            rank = np.empty(len(raw), np.uint32)
            rank[np.argsort(-np.bincount(flat, minlength=len(raw)), kind="stable")] = np.arange(len(raw), dtype=np.uint32)
            placed = _packed([sizes, rank[flat]])
            del flat
            block = next(number)
            share = np.fromiter(map(crc32, raw), np.int64, len(raw)) % shares
            by_share = np.argsort(share, kind="stable")
            edges = [*np.flatnonzero(np.diff(share[by_share], prepend=-1)).tolist(), len(raw)]
            lists = []
            for a, b in zip(edges, edges[1:], strict=False):
                own = by_share[a:b].tolist()
                lists.append(_packed([rank[own], np.array([len(raw[i]) for i in own])], b"".join([raw[i] for i in own])))
            n = len(lists)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([ids, *[None] * n], pa.list_(kind_in)),
                    pa.array([placed, *[None] * n], pa.binary()),
                    pa.array([None, *share[by_share[edges[:-1]]].tolist()], pa.int32()),
                    pa.array([None, *lists], pa.binary()),
                ],
                names=schema.names,
            )

        ids, codes, held = [], [], 0
        index: dict[str, int] = defaultdict(count().__next__)
        odd_ones: set[int] = set()  # numbers of words with a strange character
        for batch in batches:
            kind_in = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if ids and held + len(text) > BLOCK_CHARS:
                    yield flush(ids, codes, index)
                    ids, codes, held, odd_ones = [], [], 0, set()
                    index = defaultdict(count().__next__)
                known = len(index)
                found = codes_of(text, fast, index.__getitem__)
                if strange:
                    odd_ones.update(index[w] for w in islice(reversed(index), len(index) - known) if strange.search(w))
                    if odd_ones and not odd_ones.isdisjoint(found.tolist()):
                        known = len(index)
                        found = codes_of(text, slow, index.__getitem__)
                        odd_ones.update(index[w] for w in islice(reversed(index), len(index) - known) if strange.search(w))
                ids.append(doc)
                codes.append(found)
                held += len(text)
        if ids:
            yield flush(ids, codes, index)

    name, path = f"word_blocks_{uuid.uuid4().hex}", scratch_path(spark, "word-blocks")
    docs.select("doc_id", "text").mapInArrow(run, schema).write.bucketBy(partitions, "block").option("path", path).option("compression", "none").saveAsTable(name, format="parquet")
    blocks = spark.table(name).select(*schema.names)
    blocks.schema  # resolved; the files stay when the name goes
    spark.sql(f"DROP TABLE {name}")
    return blocks


def encode_words(blocks: DataFrame, path: str, pattern: str) -> DataFrame:
    """The words of all blocks, each distinct one once: places binary (the packed blocks and numbers in them), ids array of int.

    Words are dealt by share; a task takes one share of all blocks at a time.
    Every block has a word once, so no word makes a share large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode_ordinary

        def encoded(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            numbers, sizes, raw, of = [], [], [], []
            for block, packed in rows:
                (at, size), data = _unpacked(packed)
                numbers.append(at)
                sizes.append(size)
                raw.append(data)
                of.append(np.full(len(at), block))
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
            words = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.concatenate(raw).tobytes())).dictionary_encode()
            code = words.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            pairs = np.stack([np.concatenate(of), np.concatenate(numbers).astype(np.int64)], 1)[order]
            edges = np.searchsorted(code[order], np.arange(len(words.dictionary) + 1))
            for low in range(0, len(words.dictionary), 10_000):
                some = words.dictionary.slice(low, 10_000).to_pylist()
                places = [pairs[edges[k] : edges[k + 1]].tobytes() for k in range(low, low + len(some))]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.binary()), pa.array([encode(w) for w in some], pa.list_(pa.int32()))], names=["places", "ids"])

        share, rows = None, []
        for batch in batches:
            for block, this, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if this != share and rows:
                    yield from encoded(rows)
                    rows = []
                share = this
                rows.append((block, packed))
        if rows:
            yield from encoded(rows)

    dealt = blocks.filter("words is not null").select("block", "share", "words").repartition("share").sortWithinPartitions("share")
    return dealt.mapInArrow(run, "places binary, ids array<int>")


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table of a rank file: id int, token binary. A row for each token of the vocabulary, ``MAX_TOKENS`` at most."""
    ranks = ranks_of(path)
    if len(ranks) > MAX_TOKENS:
        raise ValueError(f"a vocabulary of {len(ranks)} tokens isn't broadcast")
    table = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "token": pa.array(list(ranks), pa.binary())})
    return spark.createDataFrame(table)


def decode(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Rows of a key and ``ids`` array of int to the key, ids binary (little-endian uint32) and decoded binary.

    Ids are exploded with their positions and joined with the token-byte table,
    which is broadcast; such a join keeps the order of rows, so each row's bytes
    are put together where they lie. Null or empty ids: no bytes. Null keys and
    repeated rows are kept. An id without a token is an error.
    """
    schema = T.StructType([rows.schema[key], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return _tokens(rows, path, key).mapInArrow(partial(_put_together, names=schema.names), schema)


def _tokens(rows: DataFrame, path: str, key: str) -> DataFrame:
    """A row for each id, with its place and bytes; the key stands in a row's first one."""
    pairs = rows.select(key, F.posexplode_outer("ids").alias("at", "id"))
    pairs = pairs.select(F.when(F.coalesce("at", F.lit(0)) == 0, F.col(key)).alias(key), F.coalesce("at", F.lit(0)).alias("at"), "id")
    return pairs.join(F.broadcast(token_bytes(rows.sparkSession, path)), "id", "left").select(key, "at", "id", "token")


def _put_together(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_tokens`` to one for each key."""
    held: list[pa.RecordBatch] = []

    def gathered() -> pa.RecordBatch:
        name, at, ids, token = (pa.concat_arrays([b.column(i) for b in held]) for i in range(4))
        places = at.to_numpy()
        first = np.flatnonzero(places == 0)
        if (places != np.arange(len(places)) - np.repeat(first, np.diff([*first, len(places)]))).any():
            raise ValueError("positions came out of order")
        whole = ids.is_valid().to_numpy(zero_copy_only=False)
        if not whole[places > 0].all() or (whole & token.is_null().to_numpy(zero_copy_only=False)).any():
            raise ValueError("an id has no token")
        before = np.concatenate([[0], np.cumsum(whole)])
        edges = before[[*first, len(places)]]
        numbers = pc.drop_null(ids).to_numpy().astype("<u4")
        tokens = pc.drop_null(token)
        stops = np.concatenate([[0], np.cumsum(pc.binary_length(tokens).to_numpy(), dtype=np.int64)])
        binary = lambda offsets, raw: pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw)])
        return pa.RecordBatch.from_arrays([name.take(pa.array(first)), binary(4 * edges, numbers.tobytes()), binary(stops[edges], b"".join(tokens.to_pylist()))], names=names)

    for batch in batches:
        first = np.flatnonzero(batch.column(1).to_numpy() == 0)
        if len(first):  # all rows before the last first place are whole
            held.append(batch.slice(0, first[-1]))
            if sum(b.num_rows for b in held):
                yield gathered()
            held = [batch.slice(first[-1])]
        else:
            held.append(batch)
    if held:
        yield gathered()


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words' tokens to rows of (block, entries): what a batch of words has for a block."""
    for batch in _put_together(batches, ["places", "ids", "decoded"]):
        places = [np.frombuffer(p, np.int64).reshape(-1, 2) for p in batch.column(0).to_pylist()]
        ids, decoded = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        block, at = np.concatenate([np.zeros((0, 2), np.int64), *places]).T
        word = np.repeat(np.arange(len(places)), [len(p) for p in places])
        order = np.argsort(block, kind="stable")
        edges = [*np.flatnonzero(np.diff(block[order], prepend=-1)).tolist(), len(order)]
        out = []
        for a, b in zip(edges, edges[1:], strict=False):
            own = order[a:b]
            w = word[own].tolist()
            numbers, text = [ids[i] for i in w], [decoded[i] for i in w]
            out.append(_packed([at[own], np.array([len(i) // 4 for i in numbers]), np.frombuffer(b"".join(numbers), "<u4"), np.array([len(d) for d in text])], b"".join(text)))
        yield pa.RecordBatch.from_arrays([pa.array(block[order][edges[:-1]], pa.int64()), pa.array(out, pa.binary())], names=["block", "entries"])


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def encode_documents(docs: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Each document's ids and the bytes that they decode to: doc_id, n_tokens long, ids binary (little-endian uint32), decoded binary.

    The ids are those of the ``tiktoken`` library without special tokens. Null
    or empty text: no ids and no bytes. Repeated rows and null doc_ids are kept,
    a row for each; an empty table gives no rows. Further columns are dropped.
    A text may have some 500 million tokens, as an Arrow value holds 2 GB.
    """
    path, pattern = vocabulary or default_ranks()
    blocks = word_blocks(docs, pattern)
    entries = _tokens(encode_words(blocks, path, pattern), path, "places").mapInArrow(_block_rows, "block long, entries binary")
    kind = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_type = batch.column(0).type.value_type
            for i in range(batch.num_rows):
                yield from put_together(*(batch.column(k)[i] for k in range(3)), ids_type)

    def put_together(docs_of: pa.Scalar, codes: pa.Scalar, entries: pa.Scalar, ids_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        parts = [_unpacked(e.as_py()) for e in entries.values] if entries.is_valid else []
        join = lambda arrays, kind: np.concatenate([np.zeros(0, kind), *arrays])
        at, many, flat, sizes = (join([p[0][i] for p in parts], "<u4").astype(t) for i, t in enumerate((np.int64, np.int64, "<u4", np.int64)))
        raw = join([p[1] for p in parts], np.uint8)
        del parts
        place = np.empty(len(at), np.int64)
        place[at] = np.arange(len(at))
        id_starts, byte_starts = np.cumsum(many) - many, np.cumsum(sizes) - sizes
        (counts, flat_codes), _ = _unpacked(codes.as_py())
        out: tuple[list, list, list, list] = ([], [], [], [])
        held, last = 0, len(counts) - 1
        for k, (doc, stop, n) in enumerate(zip(docs_of.as_py(), np.cumsum(counts, dtype=np.int64).tolist(), counts.tolist(), strict=True)):
            numbers, text = [], []
            for a in range(stop - n, stop, CODES_AT_ONCE):
                words = place[flat_codes[a : min(stop, a + CODES_AT_ONCE)]]
                numbers.append(_gather(flat, id_starts[words], many[words]).tobytes())
                text.append(_gather(raw, byte_starts[words], sizes[words]).tobytes())
            for values, v in zip(out, (doc, 0, b"".join(numbers), b"".join(text)), strict=True):
                values.append(v)
            out[1][-1] = len(out[2][-1]) // 4
            held += n
            if held > CODES_AT_ONCE or k == last:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (ids_type, pa.int64(), pa.binary(), pa.binary()), strict=True)], names=schema.names)
                out, held = ([], [], [], []), 0

    placed = blocks.filter("codes is not null").select("block", "doc_ids", "codes")
    whole = placed.join(entries.groupBy("block").agg(F.collect_list("entries").alias("entries")), "block", "left")
    return whole.select("doc_ids", "codes", "entries").mapInArrow(assemble, schema)
