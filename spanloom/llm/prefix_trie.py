"""A trie of conversation prefixes: ternary search trees over ranges of turn sequences.

Turns become ids of a dictionary. Conversations are cut to bands of turns, so
that no row grows with a conversation; a band knows its prefix by sums of
hashes. Bands are sorted by prefix and ids and dealt by range to shards, each of
which builds ternary search trees and sums up what lies below each node. Nodes
on a shard's first and last path may go on in another shard; these boundary
nodes are merged by key, and bands then add their sums to the bands above.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import finished, salted_join, stored

#: Turns of a band, and bands of a shard on average. They bound a task's memory.
BAND, SHARD_ROWS = 32, 8192
#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_LANES = 3
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Turns by place: conv_id long, pos long (from 1), key binary, words long.

    Ordered by turn, null first, ties by role and text; null role or text is
    empty. The key is a digest of both. Rows without conv_id are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(order).cast("long"))
    return rows.select("conv_id", "pos", F.unhex(F.substring(digest, 1, 32)).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def with_shared_starts(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their group's first one, and all their ids.

    The first h turns of conversation c are those of c - c % group, with h the
    unsigned CRC-32 of its decimal number modulo ``most``: all if that has fewer,
    none if there is no such conversation. c's own turns after its first h
    follow. One that has no turns left is among the ids only.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("long")
    first = turns.filter(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    lengths = first.groupBy("base").agg(F.max("pos").alias("held"))
    ids = turns.select("conv_id").distinct().withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h})
    ids = ids.join(lengths, "base", "left").withColumn("held", F.least("h", F.coalesce("held", F.lit(0))))
    taken = ids.join(first, "base").filter("pos <= h").select("conv_id", "pos", "key", "words")
    own = turns.filter(F.col("pos") > h).join(ids.select("conv_id", "h", "held"), "conv_id").select("conv_id", (F.col("pos") - F.col("h") + F.col("held")).alias("pos"), "key", "words")
    return stored(taken.unionByName(own), "turns"), ids.select("conv_id")


def _sequences(turns: DataFrame, ids: DataFrame, band: int) -> DataFrame:
    """Bands of dictionary-encoded turns, stored.

    Columns: conv_id, band, ids, words (arrays), last (the conversation ends
    here), p0.. (sums over the bands before) and q0.. (with this one).
    """
    words = stored(turns.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.max("words").alias("words")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    rows = turns.select("conv_id", "pos", "key", F.xxhash64("conv_id", "pos").alias("spread"))
    coded = salted_join(rows, words.select("key", "id", "words"), ["key"], "spread", counts=words.select("key", "_n"))
    bands = coded.groupBy("conv_id", F.floor((F.col("pos") - 1) / band).alias("band")).agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("t"))
    bands = bands.select("conv_id", "band", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))
    digest = F.sha2(F.concat_ws(",", F.col("band").cast("string"), F.col("ids").cast("array<string>")), 256)
    lane = lambda i: F.conv(F.substring("digest", 1 + 10 * i, 10), 16, 10).cast("long")  # noqa: E731  40 bits
    way = W.partitionBy("conv_id").orderBy("band")
    before = lambda c: F.coalesce(F.sum(c).over(way.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bands = bands.withColumn("digest", digest).withColumns({f"l{i}": lane(i) for i in range(_LANES)})
    bands = bands.withColumns({"last": F.lead("band").over(way).isNull(), **{f"p{i}": before(f"l{i}") for i in range(_LANES)}})
    bands = bands.select("conv_id", "band", "ids", "words", "last", *[f"p{i}" for i in range(_LANES)], *[(F.col(f"p{i}") + F.col(f"l{i}")).alias(f"q{i}") for i in range(_LANES)])
    none = ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    empty = {"band": F.lit(0).cast("long"), "ids": F.array().cast("array<long>"), "words": F.array().cast("array<long>"), "last": F.lit(True)}
    none = none.withColumns(empty | {f"{c}{i}": F.lit(0).cast("long") for c in "pq" for i in range(_LANES)})
    return stored(bands.unionByName(none), "sequences")


def _root_key(band: int, lanes: tuple[int, ...]) -> bytes:
    """The key of the node where a band ends and ``band`` begins. With ``-band`` it is that of the same node as the root of its band."""
    return hashlib.sha256(struct.pack(f"<{1 + _LANES}q", band, *lanes)).digest()[:16]


def _key(above: bytes, turn: int) -> bytes:
    return hashlib.sha256(above + struct.pack("<q", turn)).digest()[:16]


class _Trees:
    """The ternary search trees of a shard's bands, as lists by node; a node without a turn is the root of its prefix."""

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.equal, self.above, self.depth, self.words = ([] for _ in range(7))
        self.key: list[bytes] = []
        self.whole: dict[int, bytes] = {}

    def root(self, band: int, lanes: tuple[int, ...], depth: int) -> int:
        node = self._add(-1, -1, depth, 0, _root_key(-band, lanes))
        self.whole[node] = _root_key(band, lanes)
        return node

    def parent(self, node: int) -> bytes | None:
        """The key of the node above; for a band's root, of the node that it continues."""
        above = self.above[node]
        if above < 0:
            return self.whole[node] if self.depth[node] else None
        return self.whole.get(above, self.key[above])

    def _add(self, turn: int, above: int, depth: int, words: int, key: bytes) -> int:
        for values, v in ((self.turn, turn), (self.low, -1), (self.high, -1), (self.equal, -1), (self.above, above), (self.depth, depth), (self.words, words), (self.key, key)):
            values.append(v)
        return len(self.turn) - 1

    def insert(self, node: int, turns: list[int], words: list[int], full_key: bytes | None) -> int:
        """The node of a sequence below a root; ``full_key`` is the last node's key if the sequence fills a band."""
        for at, (turn, n) in enumerate(zip(turns, words, strict=True)):
            side, holder, found = self.equal, node, self.equal[node]
            while found >= 0 and self.turn[found] != turn:
                side, holder = (self.low if turn < self.turn[found] else self.high), found
                found = side[holder]
            if found < 0:
                key = full_key if full_key and at + 1 == len(turns) else _key(self.key[node], turn)
                found = side[holder] = self._add(turn, node, self.depth[node] + 1, n, key)
            node = found
        return node

    def order(self, root: int) -> list[int]:
        """All nodes of a root, each after the one above it."""
        out, todo = [root], [self.equal[root]]
        while todo:
            node = todo.pop()
            if node >= 0:
                out.append(node)
                todo += [self.low[node], self.high[node], self.equal[node]]
        return out


_NODE = (
    "key binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, words long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, chunk binary, chunk_first long, boundary boolean, more boolean, band_root boolean, path array<binary>"
)


def _shard(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A range of sorted bands of ``size`` turns to its nodes.

    A boundary node has what lies directly below it in this shard and isn't
    boundary itself; its own share and that of other boundary nodes come with
    the merge.
    """
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    trees = _Trees()
    lanes = lambda r, c: tuple(r[f"{c}{i}"] for i in range(_LANES))
    starts = [i for i, r in enumerate(rows) if i == 0 or (r["band"], lanes(r, "p")) != (rows[i - 1]["band"], lanes(rows[i - 1], "p"))]
    roots, ends = [], [0] * len(rows)
    for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
        band = rows[a]["band"]
        root = trees.root(band, lanes(rows[a], "p"), band * size)
        roots.append(root)
        distinct = [i for i in range(a, b) if i == a or rows[i]["ids"] != rows[i - 1]["ids"]]
        todo = [(0, len(distinct))]
        while todo:  # the median first, then those of both halves
            low, high = todo.pop()
            if low < high:
                mid = (low + high) // 2
                todo += [(low, mid), (mid + 1, high)]
                r = rows[distinct[mid]]
                node = trees.insert(root, r["ids"], r["words"], _root_key(band + 1, lanes(r, "q")) if len(r["ids"]) == size else None)
                for i in range(distinct[mid], distinct[mid + 1] if mid + 1 < len(distinct) else b):
                    ends[i] = node
    many = len(trees.turn)
    members, smallest, children, leaves, saved = [0] * many, [math.inf] * many, [0] * many, [0] * many, [0] * many
    more, boundary, ended = [False] * many, [False] * many, [[] for _ in range(many)]
    for r, node in zip(rows, ends, strict=True):
        members[node] += 1
        smallest[node] = min(smallest[node], r["conv_id"])
        if r["last"]:
            ended[node].append(r["conv_id"])
        else:
            more[node] = True
    for node in (ends[0], ends[-1]):
        while node >= 0:
            boundary[node] = True
            node = trees.above[node]
    order = [v for root in roots for v in trees.order(root)]
    for v in reversed(order):
        u = trees.above[v]
        if not boundary[v]:
            leaves[v] += children[v] == 0 and not more[v]
            saved[v] += (members[v] - 1) * trees.words[v]
        if u >= 0:
            members[u] += members[v]
            smallest[u] = min(smallest[u], smallest[v])
            if not boundary[v]:
                children[u] += 1
                leaves[u] += leaves[v]
                saved[u] += saved[v]

    def path(v: int) -> list[bytes]:
        out = []
        while v >= 0:
            out.append(trees.key[v])
            v = trees.above[v]
        return out

    names = [c.split()[0] for c in _NODE.split(", ")]
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary())}
    for at in range(0, many, 8192):
        found = []
        for v in order[at : at + 8192]:
            u = trees.above[v]
            known = u >= 0 and not boundary[u] and trees.turn[u] >= 0
            text = ",".join(map(str, ended[v])).encode()
            found.append(
                (trees.key[v], trees.parent(v), trees.depth[v], smallest[v], smallest[u] if known else None, members[v], trees.words[v], children[v], leaves[v], saved[v])
                + ((None, text or None, ended[v][0] if text else None, True) if boundary[v] else (hashlib.sha256(text).hexdigest(), None, None, False))
                + (more[v], trees.turn[v] < 0 and trees.depth[v] > 0, path(v) if boundary[v] else None)
            )
        columns = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k.split()[1]]) for c, k in zip(columns, _NODE.split(", "), strict=True)], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks of ids to a digest for each key; ids pass through one after another."""
    key, digest, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["key", "ends_sha256"])

    for batch in batches:
        for k, chunk in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if k != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(chunk.as_py())
            else:
                digest.update(b"," + chunk.as_py())
        yield out()
        done = []
    if digest is not None:
        done.append((key, digest.hexdigest()))
        yield out()


def _merged(parts: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, each one once, with all that lies below them in their band."""
    sums = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    same = [F.min(c).alias(c) for c in ("parent", "depth", "conv_id")] + [F.max(c).alias(c) for c in ("words", "more", "band_root")]
    nodes = parts.groupBy("key").agg(*same, *sums.values(), F.first("path").alias("path"))
    nodes = stored(nodes, "boundary")
    below = nodes.filter("size(path) > 1").groupBy(F.col("path")[1].alias("key")).agg(F.count(F.lit(1)).alias("more_children"))
    nodes = nodes.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more_children", F.lit(0)))
    leaf = ((F.col("n_children") == 0) & ~F.col("more")).cast("long")
    share = nodes.select(F.explode("path").alias("key"), (F.col("n_leaves") + leaf).alias("n_leaves"), (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = share.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    chunks = parts.filter("chunk is not null").select("key", "chunk", "chunk_first").repartition("key").sortWithinPartitions("key", "chunk_first")
    ended = chunks.select("key", "chunk").mapInArrow(_hashed, "key binary, ends_sha256 string")
    nodes = nodes.drop("n_leaves", "saved_tokens").join(totals, "key").join(ended, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    return nodes.withColumns({"parent_conv_id": F.lit(None).cast("long"), "boundary": F.lit(True)})


def _added(sequences: DataFrame, tops: DataFrame) -> DataFrame:
    """What the bands below a node add to it: key, more_leaves, more_saved.

    A band's sums are carried by its prefix' smallest conversation, which runs
    through all nodes above.
    """
    carried = sequences.join(tops.select("conv_id", "band", "n_leaves", "saved_tokens"), ["conv_id", "band"], "left")
    way = W.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(W.unboundedPreceding, -1)
    carried = carried.withColumns({"more_leaves": F.sum("n_leaves").over(way), "more_saved": F.sum("saved_tokens").over(way)}).filter("more_leaves is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, leaves, saved = [], [], []
            for r in batch.to_pylist():
                key = _root_key(-r["band"], tuple(r[f"p{i}"] for i in range(_LANES)))
                path = [key] if r["band"] == 0 else []  # a later band's root is the last node of the band before
                for turn in r["ids"][:-1]:
                    path.append(key := _key(key, turn))
                path.append(_root_key(r["band"] + 1, tuple(r[f"q{i}"] for i in range(_LANES))))
                keys += path
                leaves += [r["more_leaves"]] * len(path)
                saved += [r["more_saved"]] * len(path)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=["key", "more_leaves", "more_saved"])

    return carried.mapInArrow(run, "key binary, more_leaves long, more_saved long").groupBy("key").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))


def prefix_trie(turns: DataFrame, ids: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of all conversations' turns.

    ``turns``: conv_id, pos (1, 2, ..), key, words, as from ``numbered_turns``;
    ``ids``: all conv_id, those without turns too. Returns for each node, the
    root included: conv_id (its smallest member), depth, parent_conv_id (null
    for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Equal conversations are members of the same nodes. Without ids: no rows.
    """
    return finished(turns.sparkSession, "trie", lambda: _nodes(turns, ids, band, shard_rows))


def conversation_trie(conversations: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of conversations with shared starts, see ``with_shared_starts`` and ``prefix_trie``.

    Null role or text is empty, a null turn comes first, ties follow role and
    text, repeated rows are turns of their own, rows without conv_id are left
    out, an empty table gives no rows, further columns are dropped.
    """
    return finished(conversations.sparkSession, "trie", lambda: _nodes(*with_shared_starts(stored(numbered_turns(conversations), "numbered")), band, shard_rows))


def _nodes(turns: DataFrame, ids: DataFrame, band: int, shard_rows: int) -> DataFrame:
    sequences = _sequences(turns, ids, band)
    size = sequences.agg(F.count(F.lit(1)).alias("rows"), F.max("band").alias("bands")).first()
    order = ["band", *[f"p{i}" for i in range(_LANES)], "ids", "conv_id"]
    dealt = sequences.repartitionByRange(max(1, -(-size["rows"] // shard_rows)), *order).sortWithinPartitions(*order)
    parts = stored(dealt.mapInArrow(partial(_shard, size=band), _NODE), "parts")
    columns = ["key", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "boundary", "band_root"]
    nodes = stored(parts.filter("not boundary").select(*columns).unionByName(_merged(parts.filter("boundary")).select(*columns)), "nodes")
    if size["bands"]:
        tops = nodes.filter("band_root").select(F.col("parent").alias("key"), F.col("n_children").alias("more_children"), "n_leaves", "saved_tokens", "conv_id", (F.col("depth") / band).cast("long").alias("band"))
        nodes = nodes.filter("not band_root").join(_added(sequences, tops), "key", "left").join(tops.select("key", "more_children"), "key", "left")
        plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        taken = {"n_children": "more_children", "n_leaves": "more_leaves", "saved_tokens": "more_saved"}
        nodes = stored(nodes.select(*[plus(c, taken[c]) if c in taken else F.col(c) for c in columns]), "whole-nodes")
    rest: Column = F.col("parent").isNull() | F.col("parent_conv_id").isNotNull()
    known = nodes.filter(F.col("boundary") | (F.col("depth") % band == 0)).select(F.col("key").alias("parent"), F.col("conv_id").alias("found"))
    orphans = salted_join(nodes.filter(~rest), known, ["parent"], "key", "left").withColumn("parent_conv_id", F.col("found"))
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return nodes.filter(rest).select(*result).unionByName(orphans.select(*result))
