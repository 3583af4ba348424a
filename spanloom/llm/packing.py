"""Best-fit packing of token sequences with certified bin counts.

Documents are tokenised and cut to pieces; pieces are dealt to partitions of
bounded size and packed best-fit decreasing. A dual-feasible-function bound
certifies a partition whose number of bins can't be lowered. Bins with gaps of
uncertified partitions, and the emptiest bin of each certified one, are
exchanged between partitions and packed again.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import stored

CAPACITY = 2048
SEPARATOR_ID = 0
#: Items of a packing partition, on average. Bounds the memory of a task.
GROUP_ITEMS = 8192
MAX_ROUNDS = 8

_ENCODERS: dict[str, object] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use, to byte values."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str, pattern: str):
    """An encoder for a byte-level BPE vocabulary file of the ``tokenizers`` library.

    ``encode(text, allowed_special="all")`` gives the ids which that library
    gives with ``add_special_tokens=False``: an added token of the file is one
    id wherever a text holds it. ``encode_ordinary`` reads added tokens as plain
    text (``encode_special_tokens=True`` there). The merging is done by
    ``tiktoken``, which takes a quarter of the time.
    """
    if path not in _ENCODERS:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", [])
        if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take white space or stand as words only aren't supported")
        special = {t["content"]: t["id"] for t in added}
        byte_of = byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def default_tokenizer() -> tuple[str, str]:
    """Path and pre-tokenising pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def token_pieces(docs: DataFrame, tokenizer: tuple[str, str] | None = None, capacity: int = CAPACITY, added_tokens: bool = False) -> DataFrame:
    """Tokenise whole texts and cut those over ``capacity`` ids.

    Columns: doc_id, piece int (from 0), start long, length long, ids binary
    (little-endian uint32). A document's ids end with ``SEPARATOR_ID``. All
    pieces but the first have ``capacity`` ids. Null or empty text: the
    separator alone. Null or repeated doc_id: kept as they are, one set of
    pieces for each row. Further columns are dropped. With ``added_tokens`` the
    vocabulary's added tokens are one id each, as by the library's defaults;
    without, they are plain text.
    """
    path, pattern = tokenizer or default_tokenizer()
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        encode = partial(enc.encode, allowed_special="all") if added_tokens else enc.encode_ordinary

        def flush(rows):
            doc, piece, start, length, ids = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [], [], [])
            return pa.RecordBatch.from_arrays([pa.array(doc, type=kind), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

        for batch in batches:
            kind = batch.column(0).type
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), SEPARATOR_ID], dtype="<u4")
                n = len(ids)
                at, piece = 0, 0
                stop = n % capacity or capacity
                while at < n:
                    rows.append((doc, piece, at, stop - at, ids[at:stop].tobytes()))
                    at, stop, piece = stop, stop + capacity, piece + 1
                held += 4 * n
                if held > 8_000_000:
                    yield flush(rows)
                    rows, held = [], 0
            yield flush(rows)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def dff_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """A lower bound on the bins that items of these lengths need.

    The largest over two families of dual feasible functions: the one that
    rounds items over ``capacity - a`` up to a bin and drops those under ``a``,
    and the one that rounds ``(k + 1) * length / capacity`` down to k-ths.
    """
    if not len(lengths):
        return 0
    hist = np.bincount(lengths, weights=counts, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    mass, many = np.cumsum(hist * sizes), np.cumsum(hist)
    a = np.arange(0, capacity // 2 + 1)
    below = np.where(a > 0, mass[a - 1], 0)
    large = many[-1] - many[capacity - a]
    middle = mass[capacity - a] - below
    best = int((-(-(large * capacity + middle) // capacity)).max())
    for k in range(1, 33):
        x = (k + 1) * sizes
        f = np.where(x % capacity == 0, sizes * k, (x // capacity) * capacity)  # k times the function
        best = max(best, -(-int((f * hist).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, taken in the given order (longest first), and the gaps.

    ``free`` holds a bit for each gap that some open bin has; the lowest bit at
    or over the length is the best fit.
    """
    gaps: list[int] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    for i, w in enumerate(lengths.tolist()):
        fits = free >> w
        if fits:
            gap = w + (fits & -fits).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                free ^= 1 << gap
        else:
            gap, b = capacity, len(gaps)
            gaps.append(capacity)
        where[i], offset[i] = b, capacity - gap
        left = gaps[b] = gap - w
        if left:
            by_gap[left].append(b)
            free |= 1 << left
    return where, offset, np.array(gaps, np.int64)


def _pack_group(capacity: int, round_no: int, keys: list[str]):
    """Packs the items of one partition; the bins that they came in stay if no bin is saved."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", *keys], ascending=[False, *[True] * len(keys)], kind="stable", ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        bound = dff_bound(lengths, capacity)
        where, offset, gaps = best_fit_decreasing(lengths, capacity)
        ids = (np.int64(round_no) << 56) | (np.int64(group["_group"].iloc[0]) << 24) | where
        if round_no:
            before = group["sequence_id"].to_numpy(np.int64)
            old, place = np.unique(before, return_inverse=True)
            if len(old) <= len(gaps):
                ids, offset, where = before, group["offset"].to_numpy(np.int64), place
                gaps = capacity - np.bincount(place, weights=lengths).astype(np.int64)
        again = gaps > 0 if len(gaps) > bound else np.zeros(len(gaps), bool)
        again[int(gaps.argmax())] |= gaps.max() > 0
        return group.assign(sequence_id=ids, offset=offset, _open=again[where])

    return run


def pack(items: DataFrame, keys: list[str], capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Pack rows with a ``length`` of 1 to ``capacity`` into as few sequences as possible.

    ``keys`` name the rows and break ties, so that a task which runs again packs
    alike. Returns the input columns and sequence_id long, offset long (gapless
    from 0). Stops when the number of sequences equals the bound for all
    lengths, when no bin is left to exchange, or after ``max_rounds``.
    Repeated rows are packed one by one. Empty input: no rows. Null length: the row is left out,
    for it has no tokens to place.
    """
    items = items.drop("sequence_id", "offset", "_open", "_group")
    spread: Column = F.xxhash64(*keys)
    items = items.filter(F.col("length").isNotNull())
    lengths = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    if lengths and (min(lengths) < 1 or max(lengths) > capacity):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    total = sum(lengths.values())
    bound = dff_bound(np.array([*lengths], np.int64), capacity, np.array([*lengths.values()]))
    groups = max(1, math.ceil(total / group_items))
    schema = T.StructType([*items.schema.fields, T.StructField("_group", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("_open", T.BooleanType())])
    todo = items.withColumn("_group", F.pmod(spread, F.lit(groups)).cast("long"))
    done: list[DataFrame] = []
    closed = 0
    for round_no in range(max_rounds):
        packed = stored(todo.groupBy("_group").applyInPandas(_pack_group(capacity, round_no, keys), schema), f"packed-{round_no}")
        bins = packed.groupBy("sequence_id", "_open").agg(F.count("*").alias("n")).groupBy("_open").agg(F.count("*").alias("bins"), F.sum("n").alias("n"))
        at = {r["_open"]: r for r in bins.collect()}  # two rows
        if True not in at or closed + sum(r["bins"] for r in at.values()) <= bound or groups == 1:
            return _union([*done, packed])
        closed += at[False]["bins"] if False in at else 0
        done.append(packed.filter(~F.col("_open")))
        rest = packed.filter("_open")
        groups = max(1, min(groups - 1, math.ceil(at[True]["n"] / group_items)))
        todo = rest.withColumn("_group", F.pmod(F.xxhash64("sequence_id", F.lit(round_no)), F.lit(groups)).cast("long"))
    return _union([*done, rest])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).drop("_group", "_open")


def pack_documents(docs: DataFrame, tokenizer: tuple[str, str] | None = None, capacity: int = CAPACITY, carry: dict[str, Column] | None = None) -> DataFrame:
    """Documents to packed pieces: doc_id, piece, start, length, sequence_id, offset and what ``carry`` derives from ``ids``.

    By default the ids themselves. A caller that needs a digest only carries
    that, and no ids are shuffled. Nulls, empties, repeats: as in
    ``token_pieces`` and ``pack``.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    pieces = stored(token_pieces(docs, tokenizer, capacity, added_tokens=True).select("doc_id", "piece", "start", "length", *[c.alias(k) for k, c in carry.items()]), "pieces")
    return pack(pieces, ["doc_id", "piece", *carry], capacity)
