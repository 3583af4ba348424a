"""Quality scores from random-indexing word vectors and a small network.

Each word has a sparse random index vector; a word's vector is the sum of the
index vectors of its neighbours over the whole corpus. A document's vectors are
pooled to their mean and spread, and a two-layer network scores the pool; its
probabilities are calibrated by a temperature.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

#: Words are hashed to so many vectors of so many dimensions: a table of fixed size.
BUCKETS = 1 << 15
DIMENSIONS = 32
#: Entries of an index vector that are not 0, and neighbours on each side.
ENTRIES = 4
REACH = 2
#: Labelled documents that the network is fitted on at most.
SAMPLE = 20_000
HIDDEN = 32
BLOCKS = 64

_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")


class _Ids(dict):
    """Word to bucket, remembered; starts anew when it has grown large."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % BUCKETS
        return h


_IDS = _Ids()


def word_ids(text: str | None) -> np.ndarray:
    """Buckets of words, runs of symbols and line ends, case kept."""
    tokens = _TOKEN.findall(text or "")
    return np.fromiter(map(_IDS.__getitem__, tokens), np.int64, len(tokens))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's entries."""
    rng = np.random.default_rng(1)
    return rng.integers(0, DIMENSIONS, (BUCKETS, ENTRIES)), rng.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's sums of neighbours' index vectors, as one row for each block of buckets."""
    place, sign = index_vectors()
    total = np.zeros(BUCKETS * DIMENSIONS)
    held: list[np.ndarray] = []

    def add():
        ids = np.concatenate(held)
        for step in range(1, REACH + 1):
            a, b = ids[:-step], ids[step:]
            real = (a >= 0) & (b >= 0)
            a, b = a[real], b[real]
            for e in range(ENTRIES):
                total[:] += np.bincount(a * DIMENSIONS + place[b, e], weights=sign[b, e], minlength=len(total))
                total[:] += np.bincount(b * DIMENSIONS + place[a, e], weights=sign[a, e], minlength=len(total))
        held.clear()

    some = False
    gap = np.full(REACH, -1)
    many = 0
    for batch in batches:
        for text in batch.column(0):
            ids = word_ids(text.as_py())
            held += [ids, gap]
            many += len(ids)
            some = True
            if many > 1_000_000:
                add()
                many = 0
    if held:
        add()
    if some:
        yield _rows(total.reshape(BLOCKS, -1))


def _rows(blocks: np.ndarray, names: list[int] | None = None) -> pa.RecordBatch:
    """Rows of the blocks that hold anything; most sums are small or 0, so they travel as 4 bytes each, compressed."""
    names = range(len(blocks)) if names is None else names
    kept = [(k, b) for k, b in zip(names, blocks, strict=True) if b.any()]
    kinds = ["<i4" if np.abs(b).max() < 1 << 31 else "<f8" for _, b in kept]
    data = [kind.encode() + pa.compress(b.astype(kind).tobytes(), codec="zstd", asbytes=True) for kind, (_, b) in zip(kinds, kept, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.int32()), pa.array(data, pa.binary())], names=["block", "sums"])


def _sums(data: bytes) -> np.ndarray:
    kind, size = data[:3].decode(), BUCKETS * DIMENSIONS // BLOCKS
    return np.frombuffer(pa.decompress(data[3:], size * np.dtype(kind).itemsize, codec="zstd"), kind).astype(np.float64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal blocks of the partition: one row for each block, in constant memory."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = _sums(data.as_py())
            sums[block] = sums[block] + x if block in sums else x
    if sums:
        yield _rows(list(sums.values()), list(sums))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, from the neighbours in every row of ``docs`` and the bucket's own index vector.

    Sums are whole numbers, so their order doesn't matter. Each task adds up
    its rows and sends the blocks that they touch, and two rounds add up the tasks; the table that reaches the driver
    has a fixed size.
    """
    schema = "block int, sums binary"
    rows = docs.select("text").mapInArrow(_contexts, schema)
    rows = rows.repartition(BLOCKS, "block", F.pmod(F.spark_partition_id(), F.lit(8))).mapInArrow(_added, schema)
    rows = rows.repartition(BLOCKS, "block").mapInArrow(_added, schema).collect()
    total = np.zeros((BLOCKS, BUCKETS * DIMENSIONS // BLOCKS))
    for r in rows:
        total[r["block"]] = _sums(bytes(r["sums"]))
    total = total.reshape(BUCKETS, DIMENSIONS)
    total = np.sign(total) * np.log1p(np.abs(total))
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    place, sign = index_vectors()
    own = np.zeros_like(total)
    np.add.at(own, (np.repeat(np.arange(BUCKETS), ENTRIES), place.ravel()), sign.ravel())
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    return (total / np.maximum(norm, 1e-9) + 0.5 * own).astype(np.float32)


def pool(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a document's word vectors, and the spread of the steps between neighbours."""
    if not len(ids):
        return np.zeros(3 * DIMENSIONS, np.float32)
    mean, square, step = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    last = None
    for at in range(0, len(ids), 50_000):
        v = vectors[ids[at : at + 50_000]]
        mean += v.sum(0, dtype=np.float64)
        square += (v * v).sum(0, dtype=np.float64)
        d = np.diff(v, axis=0) if last is None else np.diff(np.concatenate([last, v]), axis=0)
        step += (d * d).sum(0, dtype=np.float64)
        last = v[-1:]
    n = len(ids)
    mean /= n
    return np.concatenate([mean, np.sqrt(np.maximum(square / n - mean**2, 0)), np.sqrt(step / n)]).astype(np.float32)


@dataclass
class Network:
    """Two layers; ``centre`` and ``scale`` normalise the pool, ``temperature`` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, steps: int = 800, rate: float = 0.01, decay: float = 1e-3) -> Network:
    """Adam on all rows but each fifth, which calibrate the temperature."""
    rng = np.random.default_rng(5)
    held = np.arange(len(y)) % 5 == 4
    net = Network(x.mean(0), x.std(0) + 1e-6, rng.normal(0, 0.1, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), 0.0)
    z, t = (x[~held] - net.centre) / net.scale, y[~held]
    if not len(t) or t.min() == t.max():
        net.b2, net.w2 = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(HIDDEN)
        return net
    names = ["w1", "b1", "w2", "b2"]
    m = {k: np.zeros_like(getattr(net, k)) for k in names}
    v = {k: np.zeros_like(getattr(net, k)) for k in names}
    for i in range(1, steps + 1):
        h = np.tanh(z @ net.w1 + net.b1)
        g = (1 / (1 + np.exp(-(h @ net.w2 + net.b2))) - t) / len(t)
        gh = np.outer(g, net.w2) * (1 - h * h)
        grads = {"w1": z.T @ gh + decay * net.w1, "b1": gh.sum(0), "w2": h.T @ g + decay * net.w2, "b2": g.sum()}
        for k in names:
            m[k] = 0.9 * m[k] + 0.1 * grads[k]
            v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
            setattr(net, k, getattr(net, k) - rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.999**i)) + 1e-8))
    logits, t = net.logits(x[held]), y[held]
    if len(t):
        grid = np.geomspace(0.25, 8, 61)
        net.temperature = float(min(grid, key=lambda c: np.logaddexp(0, -np.where(t > 0, 1, -1) * logits / c).mean()))
    return net


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, sample: int = SAMPLE) -> DataFrame:
    """Every row of ``docs``: doc_id, held_out, score double, predicted int.

    Learns from labelled rows outside the held-out fold: at most ``sample`` of
    them, those of the smallest hash of doc_id. Null or empty texts pool to
    zeros and are scored like others. Null labels and null doc_ids teach
    nothing; a doc_id that repeats has as many rows, and its labels as many
    examples. Without labels all scores are 0.5. Further columns of both tables
    are dropped; an empty table of documents gives no rows.
    """
    docs = docs.select("doc_id", "text")
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs))  # BUCKETS x DIMENSIONS float32: 4 MB

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pool(word_ids(t.as_py()), vectors.value).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["doc_id", "pool"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    pools = stored(docs.mapInArrow(pooled, f"doc_id {kind}, pool binary"), "pools")
    mine = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held_out, F.lit(False))
    taught = labels.filter("quality is not null and doc_id is not null").select("doc_id", "quality").filter(~mine)
    rows = pools.join(taught, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "pool", "quality").limit(sample).collect()
    if rows:
        x = np.stack([np.frombuffer(r["pool"], np.float32) for r in rows]).astype(np.float64)
        net = fit_network(x, np.array([float(r["quality"] > 0) for r in rows]))
    else:
        wide = 3 * DIMENSIONS
        net = Network(np.zeros(wide), np.ones(wide), np.zeros((wide, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([np.frombuffer(p.as_buffer(), np.float32) for p in batch.column(1)]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.score(x))], names=["doc_id", "score"])

    out = pools.mapInArrow(scored, f"doc_id {kind}, score double")
    return out.select("doc_id", mine.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
