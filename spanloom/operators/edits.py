"""Edits that depend on order within a document: text segments, span repair, passages."""

from __future__ import annotations

import base64
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.text import SPACE, context_bounds, drawn_sides


def replace_segment(docs: DataFrame, entities: DataFrame, old: str, new: str, which: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Replaces occurrences of ``old`` in texts: documents with text and n_replaced, and entities with moved offsets.

    ``which`` names one occurrence from 0; without it a text with several stops
    the job unless -1 asks for all. Entities that a replacement touches are
    dropped, those behind it move.
    """
    places = F.split("text", F.lit(_quoted(old)), -1)
    n = F.size(places) - 1
    ambiguous = F.when((n > 1) & F.lit(which is None), F.raise_error(F.lit("the segment occurs more than once")).cast("int"))
    starts = F.aggregate(F.slice(places, F.lit(1), n), F.array().cast("array<int>"), lambda acc, p: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)) + len(old), F.lit(0)) + F.length(p))))
    chosen = starts if which in (None, -1) else F.filter(starts, lambda x: x == F.get(starts, F.lit(which)))
    rows = docs.withColumn("_at", F.when(F.coalesce(ambiguous, F.lit(0)) == 0, chosen))
    step = len(new) - len(old)
    edited = F.aggregate(F.reverse("_at"), F.col("text"), lambda t, a: F.concat(F.substr(t, F.lit(1), a), F.lit(new), F.substr(t, a + len(old) + 1, F.length(t))))
    moved = entities.join(rows.select("doc_id", "_at"), "doc_id")
    touched = F.exists("_at", lambda a: (a < F.col("stop")) & (F.col("start") < a + len(old)))
    shift = F.size(F.filter("_at", lambda a: a + len(old) <= F.col("start"))) * step
    moved = moved.filter(~touched).withColumn("_by", shift).withColumn("start", F.col("start") + F.col("_by")).withColumn("stop", F.col("stop") + F.col("_by"))
    return rows.select("doc_id", edited.alias("text"), F.size("_at").alias("n_replaced")), moved.drop("_at", "_by")


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def occurrences(text: str, token: str, low: int, high: int) -> list[tuple[int, int]]:
    """All places of a token between two offsets, those that overlap too."""
    out, at = [], text.find(token, low, high) if token else -1
    while at >= 0:
        out.append((at, at + len(token)))
        at = text.find(token, at + 1, high)
    return out


def compact_projection(text: str, wanted: list[str], entities: list[tuple[int, int]], low: int = 0, high: int | None = None) -> list[tuple[int, int]] | None:
    """Places of the wanted tokens, in order and apart, between two offsets of a text; None if there are none.

    Of all choices it is that with the least width of the entities (ranges of
    ``wanted``) together, then of the whole, then the first; of equal ones that
    whose places come first. From the last token back, each occurrence keeps the
    least cost of what follows it and where that begins, so the work grows with
    the number of occurrences and not with that of their choices.
    """
    if not wanted:
        return None
    high = len(text) if high is None else high
    firsts, lasts = {a for a, b in entities if b > a}, {b - 1 for a, b in entities if b > a}
    at = [occurrences(text, token, low, high) for token in wanted]
    ahead: list[list[tuple[int, int, int]]] = []  # of each token: least (cost, end, number) of its occurrences from this one on
    for k in range(len(wanted) - 1, -1, -1):
        best: list[tuple[int, int, int]] = [(0, 0, 0)] * len(at[k])
        following = at[k + 1] if ahead else []
        run = None
        for j in range(len(at[k]) - 1, -1, -1):
            start, stop = at[k][j]
            own = (stop if k in lasts else 0) - (start if k in firsts else 0)
            if ahead:
                nearest = bisect_left(following, (stop, -1))
                found = (own + ahead[0][nearest][0], ahead[0][nearest][1], j) if nearest < len(ahead[0]) else None
            else:
                found = (own, stop, j)
            if found and (run is None or found <= run):
                run = found
            best[j] = run or (0, 0, -1)
        while best and best[-1][2] < 0:  # nothing fits behind these
            best.pop()
        if not best:
            return None
        ahead.insert(0, best)
    # the first token's own costs are compared with the width of the whole; a later start never has a later best end without cost
    options = []
    for j, (start, stop) in enumerate(at[0]):
        own = (stop if 0 in lasts else 0) - (start if 0 in firsts else 0)
        if len(wanted) == 1:
            options.append((own, stop - start, start, j))
            continue
        nearest = bisect_left(at[1], (stop, -1))
        if nearest < len(ahead[1]):
            options.append((own + ahead[1][nearest][0], ahead[1][nearest][1] - start, start, j))
    if not options:
        return None
    path = [at[0][min(options)[3]]]
    for k in range(1, len(wanted)):
        nearest = bisect_left(at[k], (path[-1][1], -1))
        path.append(at[k][ahead[k][nearest][2]])
    return path


def _entity_ranges(tags: list[str | None]) -> list[tuple[int, int]]:
    """Ranges of tokens that one entity covers: a B, or an I after nothing of its label, begins one."""
    out: list[tuple[int, int]] = []
    before = None
    for k, tag in enumerate(tags):
        label = tag[2:] if tag and tag[:2] in ("B-", "I-") else None
        if label and tag[0] == "I" and label == before:
            out[-1] = (out[-1][0], k + 1)
        elif label:
            out.append((k, k + 1))
        before = label
    return out


def projected(rows: DataFrame) -> DataFrame:
    """Adds ``places``, where wanted tokens lie in a text (an array of start and stop), null if they don't in that order.

    Columns: text, wanted (array of tokens), tags (their BIO tags) and low, high
    (offsets between which to look; null is the text's own end). Null texts and
    arrays have no places; further columns stay, but for one named ``places``.
    """
    names, kept = rows.columns, [c for c in rows.columns if c != "places"]
    place = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    schema = rows.select(*kept).schema.add("places", T.ArrayType(place))
    columns = [names.index(c) for c in ("text", "wanted", "tags", "low", "high")]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, wanted, tags, low, high in zip(*(batch.column(i) for i in columns), strict=True):
                text, wanted, tags, low, high = (x.as_py() for x in (text, wanted, tags, low, high))
                way = None if text is None or wanted is None else compact_projection(text, wanted, _entity_ranges(tags or []), low or 0, high)
                found.append(way and [{"start": a, "stop": b} for a, b in way])
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), pa.array(found, kind)], names=[*kept, "places"])

    return rows.mapInArrow(run, schema)


def repaired_spans(spans: DataFrame) -> DataFrame:
    """Character spans of accepted surfaces in a text: as given, else by token offsets, else the only occurrence, else dropped.

    (text, surface, start, stop, token_start_offset, token_stop_offset) with a ``repair`` column.
    """
    piece = lambda a, b: F.substr("text", (a + 1).cast("int"), (b - a).cast("int"))
    by_tokens = piece(F.col("token_start_offset"), F.col("token_stop_offset")) == F.col("surface")
    as_given = piece(F.col("start"), F.col("stop")) == F.col("surface")
    count = (F.length("text") - F.length(F.replace("text", "surface"))) / F.length("surface")
    where = F.when(F.coalesce(by_tokens, F.lit(False)), "tokens").when(F.coalesce(as_given, F.lit(False)), "characters").when(count == 1, "only_occurrence")
    rows = spans.withColumn("repair", where).filter("repair is not null")
    found = F.expr("locate(surface, text) - 1")
    start = F.when(F.col("repair") == "tokens", F.col("token_start_offset")).when(F.col("repair") == "characters", F.col("start")).otherwise(found)
    return rows.withColumn("start", start).withColumn("stop", F.col("start") + F.length("surface"))


def decoded_vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """``model:base64`` of little-endian float32 to model string and vector array<float>; other columns stay."""
    names = rows.columns
    at = names.index(column)
    schema = rows.select("*").schema.add("model", "string").add("vector", T.ArrayType(T.FloatType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(v or ":").partition(":") for v in batch.column(at).to_pylist()]
            vectors = [np.frombuffer(base64.b64decode(p[2]), "<f4").tolist() for p in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p[0] for p in parts]), pa.array(vectors, pa.list_(pa.float32()))], names=[*names, "model", "vector"])

    return rows.mapInArrow(run, schema)


def word_chunks(n: int, size: int, overlap: float) -> list[tuple[int, int]]:
    """Chunks of ``size`` words that overlap, the last one ending with the n words."""
    if n <= size:
        return [(0, n)] if n else []
    step = max(1, round(size * (1 - overlap)))
    return [(a, a + size) for a in dict.fromkeys([*range(0, n - size + 1, step), n - size])]


def refined_passages(docs: DataFrame, query: list[float], embed: Callable[[pd.Series], pd.Series], size: int = 180, least: int = 30, rounds: int = 3, overlap: float = 0.25, key: str = "doc_id") -> DataFrame:
    """The best passage of each document (its key and words) in each round: the key, round, start, stop, similarity.

    A round cuts the passage of the one before into chunks that overlap, the
    last one ending with it, and takes the most similar to the query vector, of
    equal ones the first. Chunks have half the size of the passage, and ``least``
    words at least; a passage of no more isn't cut again. ``embed`` maps a batch
    of texts to vectors: it gets the chunks of all documents of an Arrow batch
    at once, and words are read where they lie, so nothing is shuffled or
    copied. Null or no words: no passage.
    """
    kind = docs.schema[key].dataType.simpleString()
    wanted = np.array(query, float)
    length = math.sqrt(float(wanted @ wanted))

    def similarity(vector) -> float:
        v = np.array(vector, float)
        norm = math.sqrt(float(v @ v)) * length
        return float(v @ wanted) / norm if norm else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, words = batch.column(0), batch.column(1).to_pylist()
            open_ = {row: (0, len(w), min(size, len(w))) for row, w in enumerate(words) if w}
            out = []
            for k in range(rounds):
                parts = [(row, low + a, low + b) for row, (low, high, wide) in open_.items() for a, b in word_chunks(high - low, max(least, wide), overlap)]
                if not parts:
                    break
                vectors = embed(pd.Series([" ".join(words[row][a:b]) for row, a, b in parts]))
                best: dict[int, tuple] = {}
                for (row, a, b), vector in zip(parts, vectors, strict=True):
                    near = similarity(vector)
                    if row not in best or near > best[row][0]:
                        best[row] = (near, a, b)
                out += [(row, k, a, b, near) for row, (near, a, b) in best.items()]
                open_ = {row: (a, b, math.ceil((b - a) / 2)) for row, (_, a, b) in best.items() if b - a > least}
            row, k, a, b, near = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64())), pa.array(k, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(near, pa.float64())], names=[key, "round", "start", "stop", "similarity"])

    return docs.select(key, "words").mapInArrow(run, f"`{key}` {kind}, round int, start int, stop int, similarity double")


def context_windows(rows: DataFrame, radius: int, key: Column) -> DataFrame:
    """Adds low, high and ``context``, trimmed, to rows with text, start and stop: what stands around a match, its sides drawn by a hash of ``key``."""
    rows = rows.withColumn("_sides", drawn_sides(key, radius))
    rows = rows.withColumn("_at", context_bounds(F.col("text"), F.col("start"), F.col("stop"), F.col("_sides.before"), F.col("_sides.after")))
    cut = F.substr("text", (F.col("_at.low") + 1).cast("int"), (F.col("_at.high") - F.col("_at.low")).cast("int"))
    rows = rows.withColumns({"low": F.col("_at.low"), "high": F.col("_at.high"), "context": F.regexp_replace(cut, f"^{SPACE}++|{SPACE}++\\z", "")})
    return rows.drop("_sides", "_at")
