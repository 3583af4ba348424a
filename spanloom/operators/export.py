"""Export of reviewed rows: from accepted spans of snippets to tagged training rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.tables import token_columns
from spanloom.functions.text import LABEL_ALIASES, canonical_label, json_string_kept, strip_tags
from spanloom.sources.scratch import kept as stored

from .tokens import hinted

# States of a review whose row is exported, with and without spans.
ACCEPTED, NEGATIVE = ("auto_accepted", "accepted"), ("rejected",)
# An elided article before the French word for agency.
ELIDED = r"^[lL](['’])(?=[aA]gence\b)"
#: What stands between a text and a fragment that is added to it.
GAP = "\n...\n"
_SPAN = "struct<label:string,surface:string,start:int,stop:int,token_start:int,token_stop:int>"
_RESULT = f"text string, tokens array<string>, token_starts array<int>, token_stops array<int>, labels array<string>, spans array<{_SPAN}>, fault string"


def _exact(span: dict, starts: list[int], stops: list[int]) -> bool:
    """Whether a span's characters and tokens are given and say the same."""
    a, b, i, j = (span[k] for k in ("start", "stop", "token_start", "token_stop"))
    return None not in (a, b, i, j) and 0 <= i < j <= len(starts) and starts[i] == a and stops[j - 1] == b and a < b


def with_fragments(text: str, spans: list[dict], fragments: list[str], starts: list[int], stops: list[int]) -> tuple[str, list[dict]]:
    """The text with those match fragments behind it that hold spans which it lacks, and the spans, moved there.

    A surface that the text holds, once for each label, needs no fragment; one
    fragment serves one span.
    """
    spans = [dict(s) for s in spans]
    found = {(s["label"], s["surface"]) for s in spans if _exact(s, starts, stops)}
    left = list(fragments)
    for s in spans:
        name = (s["label"], s["surface"])
        if not s["surface"] or _exact(s, starts, stops):
            continue
        if name not in found and s["surface"] in text:
            found.add(name)
            continue
        fragment = next((f for f in left if s["surface"] in f and f not in text), None)
        if fragment is None:
            continue
        left.remove(fragment)
        s["start"] = len(text) + len(GAP) + fragment.index(s["surface"])
        s["stop"] = s["start"] + len(s["surface"])
        text += GAP + fragment
        found.add(name)
    return text, spans


def placed(span: dict, text: str, first: dict[int, int], last: dict[int, int], starts: list[int], stops: list[int]) -> dict | None:
    """The span with characters and tokens that agree: by its characters, by its tokens if it has no characters, else by the only place of its surface."""
    a, b, i, j = (span[k] for k in ("start", "stop", "token_start", "token_stop"))
    if i is None or j is None:
        return None
    if a is None or b is None:
        return {**span, "start": starts[i], "stop": stops[j - 1]} if 0 <= i < j <= len(starts) else None
    if not (0 <= a < b <= len(text) and a in first and b in last and first[a] < last[b]):
        surface = span["surface"] or ""
        a = text.find(surface) if surface else -1
        if a < 0 or text.find(surface, a + len(surface)) >= 0:
            return None
        b = a + len(surface)
    if a not in first or b not in last or first[a] >= last[b]:
        return None
    return {**span, "start": a, "stop": b, "token_start": first[a], "token_stop": last[b]}


def _rows(batches: Iterator[pa.RecordBatch], narrowed: str | None, at: tuple[int, ...], kept: list[int], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    prefix = re.compile(narrowed) if narrowed else None

    def one(text: str, spans: list[dict], fragments: list[str]) -> tuple:
        tokens, starts, stops = token_columns(text)
        n = len(text)
        text, spans = with_fragments(text, spans, fragments, starts, stops)
        more = token_columns(text[n:])  # white space stands before what is added, so the tokens before it stay
        tokens, starts, stops = tokens + more[0], starts + [n + a for a in more[1]], stops + [n + b for b in more[2]]
        first, last = {a: k for k, a in enumerate(starts)}, {b: k + 1 for k, b in enumerate(stops)}
        for turn in range(2):
            good = [p for s in spans if (p := placed(s, text, first, last, starts, stops))]
            if not turn and prefix:
                for p in good:
                    surface = text[p["start"] : p["stop"]]
                    if p["label"].startswith("org.ent.pressagency.") and (m := prefix.match(surface)):
                        p["start"] += m.end()
            good = [{**p, "surface": text[p["start"] : p["stop"]]} for p in good]
            spans = list({(p["token_start"], p["token_stop"], p["label"]): p for p in reversed(good)}.values())[::-1]
        labels = ["O"] * len(tokens)
        for p in spans:
            for k in range(p["token_start"], p["token_stop"]):
                labels[k] = ("B-" if k == p["token_start"] else "I-") + p["label"]
        return text, tokens, starts, stops, labels, spans

    for batch in batches:
        found = []
        for text, spans, fragments in zip(*(batch.column(k) for k in at), strict=True):
            row = one(text.as_py() or "", spans.as_py(), fragments.as_py())
            found.append((*row, "no_valid_span" if len(spans) and not row[5] else None))
        columns = list(zip(*found, strict=True)) if found else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)


def export_rows(rows: DataFrame, aliases: dict[str, str] = LABEL_ALIASES, narrowed: str | None = None) -> DataFrame:
    """Reviewed snippets to training rows.

    ``rows``: id, text, status, matches (array of HTML fragments), spans (array of
    label, surface, start, stop, token_start, token_stop) and further columns,
    which stay. Accepted rows are exported with their spans and rejected ones
    without any; other states, and accepted rows without spans, aren't exported.
    Labels that stand for others are replaced. A surface that the text lacks
    comes with the match that shows it (``with_fragments``); spans are placed by
    characters, tokens or surface (``placed``), equal ones once. ``narrowed`` is
    a pattern whose match at the start of an agency's surface is cut off.

    Returns source_id, id, text, tokens, token_starts, token_stops, labels (BIO
    tags), spans, negative and fault. An id that repeats is followed by a digest
    of its content; rows that are alike then are one. Faults: ``no_valid_span``,
    an accepted row none of whose spans has a place, and ``conflict``, rows of
    one id that differ in their other columns; ``id`` and tags of faulty rows
    aren't to be used. Null arrays are empty; null text is empty.
    """
    extra = [c for c in rows.columns if c not in ("id", "text", "status", "matches", "spans", "source_id", "tokens", "token_starts", "token_stops", "labels", "negative", "fault")]
    negative = F.col("status").isin(*NEGATIVE)
    spans = F.when(negative, F.array().cast(f"array<{_SPAN}>")).otherwise(F.coalesce("spans", F.array()).cast(f"array<{_SPAN}>"))
    spans = F.transform(spans, lambda s: s.withField("label", canonical_label(s["label"], aliases)))
    fragments = F.transform(F.coalesce("matches", F.array().cast("array<string>")), lambda m: F.regexp_replace(strip_tags(m), r"^\s+|\s+$", ""))
    chosen = rows.filter(F.col("status").isin(*ACCEPTED, *NEGATIVE)).filter(negative | (F.size(F.coalesce("spans", F.array())) > 0))
    chosen = chosen.select(F.col("id").alias("source_id"), *extra, negative.alias("negative"), "text", spans.alias("spans"), fragments.alias("matches"))
    kept = ["source_id", *extra, "negative"]
    result = T._parse_datatype_string(_RESULT)
    schema = T.StructType([*chosen.select(*kept).schema.fields, *result.fields])
    span = pa.struct([("label", pa.string()), ("surface", pa.string()), *[(k, pa.int32()) for k in ("start", "stop", "token_start", "token_stop")]])
    kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(span), pa.string()]
    n = len(kept)
    done = chosen.mapInArrow(partial(_rows, narrowed=narrowed, at=(n, n + 1, n + 2), kept=list(range(n)), names=schema.names, kinds=kinds), schema)
    # ids are told by all rows: they are found on a few short columns, and meet what was made, which is stored, by its number
    done = stored(done.withColumn("_at", F.monotonically_increasing_id()), "exported")
    number = lambda c: c.cast("string")
    listed = F.transform("spans", lambda s: F.concat(F.lit('{"label": '), json_string_kept(s["label"]), F.lit(', "start": '), number(s["start"]), F.lit(', "stop": '), number(s["stop"]), F.lit(', "token_start": '), number(s["token_start"]), F.lit(', "token_stop": '), number(s["token_stop"]), F.lit("}")))
    payload = F.concat(F.lit('{"id": '), json_string_kept(F.col("source_id")), F.lit(', "spans": ['), F.array_join(listed, ", "), F.lit('], "text": '), json_string_kept(F.col("text")), F.lit("}"))
    other = F.sha1(F.to_json(F.struct(*extra, "negative", "digest"), {"ignoreNullFields": "false"}))
    named = done.withColumn("digest", F.sha1(payload)).select("_at", "source_id", "fault", "digest", other.alias("other"))
    many = F.count(F.when(F.col("fault").isNull(), 1)).over(W.partitionBy("source_id"))
    named = named.withColumn("id", F.when(many > 1, F.concat("source_id", F.lit("#snippet-"), F.substring("digest", 1, 10))).otherwise(F.col("source_id")))
    good = named.filter("fault is null").groupBy("id").agg(F.min_by("_at", "other").alias("_at"), F.when(F.min("other") != F.max("other"), "conflict").alias("fault"))
    ids = stored(good.select("_at", "id", "fault").unionByName(named.filter("fault is not null").select("_at", "id", "fault")), "ids")
    return done.drop("fault").join(hinted(ids, 500_000), "_at").select("source_id", "id", *[c for c in schema.names if c not in ("source_id", "fault")], "fault")
