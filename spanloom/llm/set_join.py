"""Jaccard join of word-shingle sets by PartEnum signatures.

Two sets whose Jaccard similarity reaches the threshold differ in a bounded
number of features. The feature domain is partitioned, each partition into
sub-partitions, and a set signs each way to leave one sub-partition out: sets
of an equal-size band that are similar enough share a signature, always. What
shares a signature is verified on the whole texts. Many sets that differ share
a signature where they have a passage in common; the rows of such a signature
meet by their rarest features only, which similar sets share as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, salted_join, stored

#: Sizes of a band span this ratio; a set signs for one or two bands.
BAND_RATIO = 1.5
#: Sub-partitions of a partition; a signature leaves one out.
SUBS = 3
#: Bits of the bitmap that bounds a pair's difference almost exactly.
BITS = 4096
#: 64-bit words of the same bitmap folded: a coarser bound that is cheap to move and to compare.
FOLDS = 8
_FOLDED = [f"f{i}" for i in range(FOLDS)]
#: Sets that a task remembers to have signed.
SIGNED = 1_000_000
#: Edges that a task unites on its own, on average.
PART_EDGES = 500_000
#: Rows of a block: the rows of a signature are compared block with block.
BLOCK = 256
#: Rows of a signature of which all pairs are compared; those of a larger one meet by their rarest features.
MOST_ROWS = 16
#: Sets by which common features are told, and how many of these; the order of features costs or saves time, it changes no result.
RANKED_SETS, RANKED_FEATURES = 5_000, 65_536
#: Pairs whose whole bitmaps a task compares at a time, on average.
PAIRS_A_TILE = 50_000
#: Further pivots that rows of one signature are compared with before they are compared with one another.
PIVOT_TURNS = 1
#: Pairs that share one copy of the more frequent side's text.
PAIRS_A_COPY = 256

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: A random number for each byte; A-Z have those of a-z.
_BYTE = np.random.default_rng(4).integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BASE, _BASE_INVERSE = np.uint64(0xD6E8FEB86659FD93), np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_CHUNK = 1 << 20


@cache
def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(_CHUNK, base)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of a text's words in order, from its bytes.

    A word's hash is the sum of its bytes' numbers times powers of an odd
    base, so one running sum over the text has them all. Words are maximal runs
    without ASCII white space; A-Z count as a-z.
    """
    out = []
    at = 0
    held, power = np.zeros(1, np.uint64), np.ones(1, np.uint64)  # of a word that the chunks before began
    while at < len(raw):
        part = raw[at : at + _CHUNK - 1]
        space = _SPACE[part]
        more = at + len(part) < len(raw)
        if more and (breaks := np.flatnonzero(space)).size:
            part, more = part[: breaks[-1] + 1], False
            space = space[: len(part)]
        edge = np.diff(np.concatenate([[True], space, [True]]).view(np.int8))
        start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _powers(_BASE)[: len(part)], out=sums[1:])
        at += len(part)
        if more:  # all one word, which goes on
            held, power = held + power * sums[-1:], power * _powers(_BASE)[len(part)]
            continue
        found = (sums[stop] - sums[start]) * _powers(_BASE_INVERSE)[start]
        if power[0] != 1:
            if len(start) and start[0] == 0:
                found[:1] = held + power * found[:1]
            else:
                found = np.concatenate([held, found])
            held, power = np.zeros(1, np.uint64), np.ones(1, np.uint64)
        out.append(mixed(found))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: pa.Scalar | bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text in UTF-8.

    Fewer words than ``width`` make one shingle; none make none.
    """
    raw = text.as_buffer() if isinstance(text, pa.Scalar) else text
    h = word_hashes(np.frombuffer(raw, np.uint8)) if raw else np.empty(0, np.uint64)
    if not len(h):
        return h
    size = min(width, len(h))
    n = len(h) - size + 1
    total = np.full(n, np.uint64(size))
    for i in range(size):
        total = total * _M1 + h[i : i + n]
        total ^= total >> np.uint64(32)
    total = np.sort(mixed(total))
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def max_difference(a, b, percent: int):
    """The most features in one set of a linked pair of these sizes but not in both."""
    return (a + b) * (100 - percent) // (100 + percent)


@cache
def bands(percent: int, upto: int) -> list[tuple[int, int]]:
    """Smallest and largest size of each band: any two linkable sizes share one."""
    out, high = [], 0
    while high < upto:
        low = -(-percent * (high + 1) // 100)
        high = max(6, int(high * BAND_RATIO) + 1)
        out.append((low, high))
    return out


@cache
def _salts(band: int, n: int) -> np.ndarray:
    return mixed((np.arange(n, dtype=np.uint64) + np.uint64(1)) * _GOLD + np.array([band], np.uint64) * _M2)


def signatures(features: np.ndarray, percent: int) -> np.ndarray:
    """PartEnum signatures of a sorted set of 64-bit features.

    A band whose sets differ by at most k features has k // 2 + 1 partitions,
    so that one of them differs by at most 1, and some more: a set with no
    more thin partitions (an empty projection) than these needs no signature of
    an empty projection, for a partition that isn't thin is left to match in.
    """
    n = len(features)
    if not n:
        return np.empty(0, np.uint64)
    out = []
    all_bands = bands(percent, 1 << max(8, n.bit_length() + 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(features ^ _GOLD), dtype=np.uint64)])
    for band, (low, high) in enumerate(all_bands):
        if not low <= n <= high:
            continue
        most = max_difference(high, high, percent)
        if most == 0:
            out.append(mixed(sums[-1:] + _salts(band, 1)))
            continue
        spare = 1 + most // 60
        parts = most // 2 + 1 + spare
        cells = parts * SUBS
        at = ((features >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
        many = np.bincount(at.view(np.int64), minlength=cells).reshape(parts, SUBS)
        ends = np.concatenate([[0], np.cumsum(many)])
        sub = (sums[ends[1:]] - sums[ends[:-1]]).reshape(parts, SUBS)
        left = sub.sum(axis=1, dtype=np.uint64)[:, None] - sub
        empty = many.sum(axis=1)[:, None] == many
        signed = mixed(left.ravel() + _salts(band, cells))
        if int(empty.any(axis=1).sum()) <= spare:
            signed = signed[~empty.ravel()]
        out.append(signed)
    return np.concatenate(out)


def _parities(h: np.ndarray) -> np.ndarray:
    """Bit i tells whether the number of features in cell i of ``BITS`` is odd: sets differ in as many features as bits, or more."""
    return np.packbits(np.bincount((h >> np.uint64(52)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).view(np.int64)


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, bits = [], [], [], [np.empty((0, BITS // 64), np.int64)]
            for text in batch.column(1).cast(pa.binary()):
                h = shingles(text, width)
                n.append(len(h))
                one.append(mixed(h ^ _M1).sum(dtype=np.uint64))
                two.append(mixed(h ^ _M2).sum(dtype=np.uint64))
                bits.append(_parities(h)[None, :])
            full = np.concatenate(bits)
            folded = np.bitwise_xor.reduce(full.reshape(len(n), -1, FOLDS), axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (BITS // 64)), pa.array(full.ravel()))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)), *[pa.array(folded[:, i]) for i in range(FOLDS)], lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", *_FOLDED, "bits"])

    return run


def _signature_rows(width: int, percent: int):
    """(sig, node) of every document with an id; node is the hash of its set, the same for copies.

    Copies that a task has signed already sign no more, so that a set has at
    most one row a task and signature, however many copies there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids, sigs):
            nodes = np.repeat(np.array(ids, np.uint64).view(np.int64), [len(s) for s in sigs])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(nodes)], names=["sig", "node"])

        signed: set[int] = set()
        for batch in batches:
            ids, sigs, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                if doc is None or not len(h := shingles(text, width)):
                    continue
                node = int(mixed(h ^ _M1).sum(dtype=np.uint64))
                if node in signed:
                    continue
                if len(signed) >= SIGNED:
                    signed.clear()
                signed.add(node)
                ids.append(node)
                sigs.append(s := signatures(h, percent))
                held += len(s)
                if held > 500_000:
                    yield flush(ids, sigs)
                    ids, sigs, held = [], [], 0
            if ids:
                yield flush(ids, sigs)

    return run


def _rarest(width: int, percent: int, common: np.ndarray, counts: np.ndarray):
    """(sig, rep, class): the rarest features of each text of (doc_id, class, text), one of which similar sets share.

    Sets of similarity ``percent`` share that share of the larger one's
    features, and so one of the first ``n - ceil(percent * n / 100) + 1`` in any
    order that is the same for all: here by ``counts`` of the features that are
    ``common``, others first.
    """
    common, counts = np.append(common, np.uint64(2**64 - 1)), np.append(counts, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [np.empty(0, np.uint64)], []
            for text in batch.column(2).cast(pa.binary()):
                h = shingles(text, width)
                at = np.searchsorted(common, h)
                many = np.where(common[at] == h, counts[at], 0)
                found.append(h[np.lexsort((h, many))[: len(h) - -(-percent * len(h) // 100) + 1]])
                sizes.append(len(found[-1]))
            which = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), batch.column(0).take(which), batch.column(1).take(which)], names=["sig", "rep", "class"])

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's edges (a, b), each with the smallest node that these edges reach from it."""
    ends = [(b.column(0), b.column(1)) for b in batches if b.num_rows]
    if not ends:
        return
    kind = ends[0][0].type
    sides = [pa.chunked_array([e[i] for e in ends]).to_numpy() for i in (0, 1)]
    nodes, at = np.unique(np.concatenate(sides), return_inverse=True)  # in order, so the least place is the smallest node
    x, y = np.split(at, 2)
    least = np.arange(len(nodes))
    while ((p := least[x]) != (q := least[y])).any():
        np.minimum.at(least, np.maximum(p, q), np.minimum(p, q))
        while ((onward := least[least]) != least).any():
            least = onward
    yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(nodes[least], kind)], names=["node", "component"])


def components(edges: DataFrame, most_rounds: int = 60, part_edges: int = PART_EDGES) -> DataFrame:
    """Connected components of edges (a, b): node and component, its smallest node.

    Edges are dealt to parts of a bounded size, each of which unites its own; if
    there is more than one part, what they found goes on in large-star and
    small-star steps until no edge moves. Such a step is one grouping and one
    join, nothing is gathered. Nodes without an edge to another node don't
    appear.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stored(edges, "edges")
    parts, before = -(-edges.count() // part_edges), None
    kind = edges.schema["a"].dataType.simpleString()
    united = edges.repartition(max(1, parts)).mapInArrow(_united, f"node {kind}, component {kind}")
    if parts <= 1:
        return united
    old, edges = edges, stored(united.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).distinct(), "edges")
    discard(old)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = salted_join(both.filter("b > a"), least, ["a"], "b").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stored(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = salted_join(large, low, ["a"], "b").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        old, edges = edges, stored(small, "edges")
        discard(old, large)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError("the components did not settle")


def _alike(percent: int):
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        """The pairs of a tile that sizes and whole bitmaps don't rule out."""
        place = {doc: k for k, doc in enumerate(sets.column("doc_id").to_pylist())}
        n = sets.column("n_shingles").to_numpy()
        told = pc.is_valid(sets.column("bits")).to_numpy()
        bits = np.zeros((len(n), BITS // 64), np.uint64)
        bits[told] = pc.list_flatten(sets.column("bits")).to_numpy().reshape(-1, BITS // 64).view(np.uint64)
        x, y = (np.array([place[d] for d in pairs.column(side).to_pylist()], np.int64) for side in ("a", "b"))
        keep = []
        for at in range(0, len(x), 8192):
            p, q = x[at : at + 8192], y[at : at + 8192]
            difference = np.bitwise_count(bits[p] ^ bits[q]).sum(1, dtype=np.int64)
            close = 100 * np.minimum(n[p], n[q]) >= percent * np.maximum(n[p], n[q])
            keep.append((close & (difference <= max_difference(n[p], n[q], percent))) | ~(told[p] & told[q]))
        return pairs.select(["a", "b"]).filter(pa.array(np.concatenate([np.zeros(0, bool), *keep])))

    return run


def alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), stored ones, whose whole bitmaps leave the similarity possible. ``sets``: a row of doc_id, n_shingles and bits for each; null bits leave it possible.

    Pairs are dealt to tiles by both sides' hashes, and a set goes once to each
    tile that needs it: among d sets that are compared with one another, the
    bitmaps that move grow with d times the root of the pairs and not with the
    pairs.
    """
    sides = max(1, math.ceil(math.sqrt(pairs.count() / PAIRS_A_TILE)))
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(sides))
    dealt = pairs.select("a", "b", (part("a") * sides + part("b")).alias("tile"))
    needed = dealt.select(F.explode(F.array("a", "b")).alias("doc_id"), F.col("tile").alias("at")).distinct().join(sets.select("doc_id", "n_shingles", "bits"), "doc_id")
    return dealt.groupBy("tile").cogroup(needed.groupBy("at")).applyInArrow(_alike(percent), pairs.select("a", "b").schema)


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            keep = []
            for one, other in zip(batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary()), strict=True):
                x = shingles(one, width)
                if (text := other.as_py()) != last or held is None:
                    last, held = text, shingles(text, width)
                both = len(x) + len(held) - len(np.union1d(x, held))
                keep.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(held) - both))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the similarity.

    b may stand in very many pairs: its text is copied once for every
    ``PAIRS_A_COPY`` of them and each copy meets its own share.
    """
    copies = pairs.groupBy("b").agg(F.ceil(F.count("*") / PAIRS_A_COPY).cast("int").alias("copies"))
    dealt = pairs.join(copies, "b").withColumn("copy", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int"))
    right = copies.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    met = dealt.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(right, ["b", "copy"])
    return met.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, percent), pairs.select("a", "b").schema)


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate classes: doc_id, n_shingles, rep, component_id for every row of ``docs``.

    Rows link when ``100 * |A & B| >= percent * |A | B|`` for their shingle
    sets. ``rep`` is the smallest id with the same set, component_id the
    smallest id that links reach. No links are lost: sets that share no
    signature can't be linked, and of those that share one every pair is
    verified, but for pairs that are in one component already and for pairs of
    a large signature that share none of their rarest features.

    Null or empty text, or no words: an empty set, linked with nothing, not even
    other empty sets. Null doc_id: its row is returned, unlinked. Rows of a
    repeated doc_id are documents that bear the same id. Empty input: no rows.
    Further columns are dropped.
    """
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    folded = "".join(f", {c} long" for c in _FOLDED)
    feats = stored(docs.mapInArrow(_features(width), f"doc_id {id_type}, n_shingles long, set_a long, set_b long{folded}, bits array<long>"), "sets")
    known = feats.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "set_a", "set_b"]
    reps = stored(known.groupBy(*same).agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in _FOLDED]), "reps")
    nodes = reps.select(F.col("set_a").alias("node"), "rep", "n_shingles", *_FOLDED)

    def slim(side: str) -> DataFrame:
        return reps.select(F.col("rep").alias(side), F.struct("n_shingles", *_FOLDED).alias(f"of_{side}"))

    over = lambda what, name: F.expr(f"{what} over (partition by sig)").alias(name)
    rows = docs.mapInArrow(_signature_rows(width, percent), "sig long, node long")
    shared = rows.repartition("sig").select("sig", "node", over("min(node)", "low"), over("max(node)", "high")).filter("low <> high").select("sig", "node").dropDuplicates(["sig", "node"])
    buckets = stored(shared.select("sig", "node", over("min(node)", "pivot"), over("count(*)", "m")), "buckets")

    gap = "aggregate(zip_with(x.bits, y.bits, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)"

    def near(x: str, y: str, difference: str = "") -> str:
        """That neither the sizes nor a lower bound on the difference, by default that of the folded bitmaps, rule the pair out."""
        difference = difference or " + ".join(f"bit_count({x}.{c} ^ {y}.{c})" for c in _FOLDED)
        return f"100 * least({x}.n_shingles, {y}.n_shingles) >= {percent} * greatest({x}.n_shingles, {y}.n_shingles) and {difference} <= ({x}.n_shingles + {y}.n_shingles) * {100 - percent} div {100 + percent}"

    def possible(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that the whole bitmaps don't rule out, stored."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        bits = stored(known.join(wanted, "doc_id", "left_semi").select("doc_id", "n_shingles", "bits").distinct(), "bits")
        x, y = (bits.select(F.col("doc_id").alias(side), F.struct("n_shingles", "bits").alias(of)) for side, of in (("a", "x"), ("b", "y")))
        out = stored(salted_join(pairs.join(x, "a"), y, ["b"], "a").filter(near("x", "y", gap)).select("a", "b").distinct(), name)
        discard(bits, pairs)
        return out

    star = stored(buckets.filter("node <> pivot").select("node", "pivot").distinct(), "met")
    star = star.join(nodes.select("node", F.col("rep").alias("a"), F.struct("n_shingles", *_FOLDED).alias("x")), "node").drop("node")
    star = salted_join(star, nodes.select(F.col("node").alias("pivot"), F.col("rep").alias("b"), F.struct("n_shingles", *_FOLDED).alias("y")), ["pivot"], "a")
    star = possible(stored(star.filter(near("x", "y")).select("a", "b").distinct(), "near"), "star")

    classes: DataFrame | None = None

    def settled(pairs: DataFrame) -> DataFrame:
        """The classes with the links that the texts confirm among the pairs; new links join whole classes."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        texts = stored(docs.join(wanted, "doc_id", "left_semi"), "texts")
        links = stored(verified(pairs, texts, width, percent), "links")
        discard(texts)
        if classes is None:
            return stored(components(links), "classes")
        for side in ("a", "b"):
            of = classes.select(F.col("node").alias(side), "component")
            links = links.join(of, side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
        joined = stored(components(links), "joined")
        moved = classes.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
        new = joined.join(classes.select("node"), "node", "left_anti")
        return stored(moved.unionByName(new.select("node", "component")), "classes")

    def apart(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are not in one class yet, stored."""
        of = lambda side: classes.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}"))
        return stored(salted_join(pairs.join(of("a"), "a", "left"), of("b"), ["b"], "a", "left").filter("coalesce(in_a, a) <> coalesce(in_b, b)").select("a", "b"), "apart")

    classes = settled(stored(star.groupBy("a").agg(F.min("b").alias("b")), "first"))
    rest = apart(star)
    if not rest.isEmpty():
        classes = settled(rest)
    # rows that share a signature but are in several classes still meet other pivots, and in the end one another
    seen = star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def divided(rows: DataFrame) -> DataFrame:
        """The rows (sig, rep, class) of signatures that several classes share, and how many rows these have, stored."""
        rows = rows.select("*", over("min(class)", "low"), over("max(class)", "high"), over("count(*)", "m"))
        return stored(rows.filter("low <> high").drop("low", "high"), "undecided")

    def undecided(rows: DataFrame) -> DataFrame:
        """The rows of signatures that rows of several classes share, with their class."""
        of = classes.select(F.col("node").alias("rep"), "component")
        return divided(rows.join(of, "rep", "left").select("sig", "rep", F.coalesce("component", "rep").alias("class")))

    def by_rarest(rows: DataFrame) -> DataFrame:
        """``rows`` with those of large signatures dealt by their sets' rarest features instead."""
        large = stored(rows.filter(F.col("m") > MOST_ROWS).select(F.col("rep").alias("doc_id"), "class").distinct(), "large")
        many = large.count()
        if not many:
            return rows
        texts = stored(docs.join(large, "doc_id").select("doc_id", "class", "text"), "texts")
        schema, none = f"sig long, rep {id_type}, class {id_type}", np.empty(0, np.uint64)
        some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(-(-many // RANKED_SETS))) == 0).mapInArrow(_rarest(width, 0, none, none), schema)
        ranked = some.groupBy("sig").count().filter("count > 1").orderBy(F.desc("count"), "sig").limit(RANKED_FEATURES).toArrow()  # RANKED_FEATURES at most
        common, counts = (c.to_numpy() for c in ranked.columns)
        order = np.argsort(common.view(np.uint64))
        rare = texts.mapInArrow(_rarest(width, percent, common.view(np.uint64)[order], counts[order]), schema)
        rare = divided(rare.repartition("sig").dropDuplicates(["sig", "rep"]))
        discard(large, texts)
        return rows.filter(F.col("m") <= MOST_ROWS).unionByName(rare)

    several = undecided(buckets.filter("m > 2").join(nodes.select("node", "rep"), "node").select("sig", "rep"))
    for turn in range(PIVOT_TURNS):
        pivot = f"min_by(struct(rep, class), xxhash64(rep, {turn}))"
        met = stored(several.select("rep", "class", over(pivot, "p")).filter("class <> p.class").select(F.col("rep").alias("a"), F.col("p.rep").alias("b")).distinct(), "met")
        pairs = salted_join(met.join(slim("a"), "a"), slim("b"), ["b"], "a").filter(near("of_a", "of_b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        pairs = possible(stored(pairs.join(seen, ["a", "b"], "left_anti"), "near"), "turn")
        if pairs.isEmpty():
            break
        seen = seen.unionByName(pairs)
        classes = settled(pairs)
        several = undecided(several.select("sig", "rep"))
    several = by_rarest(several)
    # one of the signatures that the same rows share is enough
    one_each = several.groupBy("sig").agg(F.count("*").alias("m"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("rows"), F.min("rep").alias("low"), F.max("rep").alias("high")).groupBy("m", "rows", "low", "high").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    last = several.select("sig", "rep", "class").join(one_each, "sig").join(slim("rep"), "rep").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    last = stored(last.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))), "blocks")
    x, y = last.alias("x"), last.alias("y")
    pairs = x.join(y, F.expr(f"x.sig = y.sig and x.block = y.other and x.other = y.block and x.rep > y.rep and x.class <> y.class and {near('x.of_rep', 'y.of_rep')}")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    pairs = stored(pairs, "met")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # an id that bears several sets has no bitmap of its own
    bits = known.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.when(F.min("set_a") == F.max("set_a"), F.first("bits")).alias("bits"))
    others = stored(alike(pairs, bits, percent).join(seen, ["a", "b"], "left_anti"), "others")
    discard(last, pairs)
    if not others.isEmpty():
        classes = settled(others)

    of = classes.select(F.col("node").alias("rep"), "component")
    classed = reps.join(of, "rep", "left").select(*same, "rep", F.coalesce("component", "rep").alias("component_id"))
    grouped = salted_join(known.select("doc_id", *same), classed, same, "doc_id").select("doc_id", "n_shingles", "rep", "component_id")
    alone = feats.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("rep"), F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone)
