"""Append-only decision logs: folding, validation, and replay on spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spans import SPAN
from .tokens import together

TERMINAL = ["done", "ignored"]
CHOICES = ["gold", "prediction", "both", "manual", "neither", "skip"]
#: What a curation choice holds, in the order in which it is replayed.
CHOICE = ["ord", "choice", "correct_label", "gold", "predicted"]


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; one grouping with a partial step, so a busy key costs no more."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def queue_status(items: DataFrame, decisions: DataFrame, key: str = "review_id") -> DataFrame:
    """Items with the status of their latest decision; without one they are todo."""
    return items.join(decisions.select(key, F.col("status").alias("decided")), key, "left").withColumn("status", F.coalesce("decided", F.lit("todo"))).drop("decided")


def queue_summary(items: DataFrame, *by: str) -> DataFrame:
    """Counts by status of queue items, and how many wait."""
    return items.groupBy(*by).agg(F.count("*").alias("total"), *[F.sum((F.col("status") == s).cast("long")).alias(s) for s in (*TERMINAL, "todo")], F.sum((~F.col("status").isin(*TERMINAL)).cast("long")).alias("pending"))


def validation_errors(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """Faults of the latest decisions (review_id, status, choice, label, n_spans) on known items; stale ids are left out.

    review_id, rule: undecided, bad_status, bad_choice, label_missing,
    spans_missing. Ignored items are complete.
    """
    known = items.select("review_id").distinct().join(decisions, "review_id", "left")
    done = F.col("status") == "done"
    bad = ~F.coalesce("choice", F.lit("")).isin(*CHOICES)
    rules = F.array(
        F.when(F.col("status").isNull() | (F.col("status") == "todo"), "undecided"),
        F.when(~F.col("status").isin("done", "ignored", "todo"), "bad_status"),
        F.when(done & bad, "bad_choice"),
        F.when(done & (F.col("choice") == "manual") & (F.coalesce("label", F.lit("")) == ""), "label_missing"),
        F.when(done & (F.col("choice") == "manual") & (F.coalesce("n_spans", F.lit(0)) == 0), "spans_missing"),
    )
    return known.select("review_id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))


def page(queue: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first ``most`` items in order, each with the queue's total and how many were left out."""
    total = queue.count()
    return queue.orderBy(*order).limit(most).withColumn("total", F.lit(total).cast("long")).withColumn("omitted", F.lit(max(0, total - most)).cast("long")).withColumn("exhaustive", F.lit(total <= most))



class _Held:
    """A document's spans, found by the blocks of 64 tokens that they touch."""

    def __init__(self, spans: dict):
        self.spans, self.blocks = {}, {}
        for span, value in spans.items():
            self.put(span, value)

    @staticmethod
    def _touched(a: int, b: int) -> range:
        return range(a // 64, max(a, b - 1) // 64 + 1)

    def put(self, span: tuple[int, int], value: object) -> None:
        self.spans[span] = value
        for k in self._touched(*span):
            self.blocks.setdefault(k, set()).add(span)

    def drop(self, span: tuple[int, int]) -> None:
        if span in self.spans:
            del self.spans[span]
            for k in self._touched(*span):
                self.blocks[k].discard(span)

    def meeting(self, a: int, b: int) -> set[tuple[int, int]]:
        return {s for k in self._touched(a, b) for s in self.blocks.get(k, ()) if s[0] < b and a < s[1]}


def _structs(column: pa.ListArray) -> list[list[tuple]]:
    """A column of lists of structs as lists of tuples, and what lists of structs these hold as well; null lists are empty."""
    each = column.flatten()
    fields = [_structs(f) if pa.types.is_list(f.type) and pa.types.is_struct(f.type.value_type) else f.to_pylist() for f in each.flatten()]
    rows, out, at = list(zip(*fields, strict=True)), [], 0
    for n in pc.list_value_length(column).to_pylist():
        out.append(rows[at : at + (n or 0)])
        at += n or 0
    return out


def _replayed(docs: DataFrame, replay: Callable[[list[tuple], list[tuple]], dict], *added: str) -> DataFrame:
    """What ``replay`` makes of each document's (doc_id, spans, log): spans by (token_start, token_stop), label and further values.

    Documents pass as rows with arrays, many in a batch: a group of its own for
    each would cost some ten milliseconds, whatever it holds.
    """
    names = ["token_start", "token_stop", "label", *added]
    kinds = [pa.int32(), pa.int32(), *[pa.string()] * (1 + len(added))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows = [], []
            for k, (mine, log) in enumerate(zip(_structs(batch.column(1)), _structs(batch.column(2)), strict=True)):
                held = replay(mine, log)
                rows += [(*span, *held[span]) for span in sorted(held)]
                of += [k] * len(held)
            cells = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, t) for c, t in zip(cells, kinds, strict=True))], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "spans", "log").mapInArrow(run, f"doc_id {kind}, token_start int, token_stop int, " + ", ".join(f"{c} string" for c in names[2:]))


def _gathered(spans: DataFrame, log: DataFrame, *columns: str) -> DataFrame:
    """A row for each document of either table: doc_id, spans and log, arrays."""
    mine, entry = F.struct("token_start", "token_stop", "label"), F.struct(*columns)
    none = lambda df, c: F.lit(None).cast(df.select(c).schema[0].dataType)
    log = log.toDF(*log.columns)  # may derive from the spans
    left = spans.select("doc_id", mine.alias("s"), none(log, entry.alias("d")).alias("d"))
    right = log.select("doc_id", none(spans, mine.alias("s")).alias("s"), entry.alias("d"))
    return together(left, right).groupBy("doc_id").agg(F.collect_list("s").alias("spans"), F.collect_list("d").alias("log"))


def _nulls_last(*values: object) -> list[tuple]:
    return [(v is None, v) for v in values]


def apply_choices(spans: DataFrame, decisions: DataFrame) -> DataFrame:
    """Replays curation choices on each document's spans in order of ``ord``.

    decisions: doc_id, ord, choice, correct_label, gold and predicted (arrays of
    (token_start, token_stop, label)). gold, prediction and both put those spans
    in place of what the item shows; manual puts the item's place with the
    correct label; neither removes; skip does nothing. A choice may relabel with
    correct_label. One document's spans and decisions are one group.
    """
    return replayed_choices(_gathered(spans, decisions, *CHOICE))


def replayed_choices(docs: DataFrame) -> DataFrame:
    """The same for documents as rows: doc_id, spans (array of token_start, token_stop, label) and log (array of ``CHOICE``)."""

    def replay(mine: list[tuple], log: list[tuple]) -> dict:
        held = _Held({(a, b): (label,) for a, b, label in mine})
        for _, choice, correct, gold, pred in sorted(log, key=lambda d: _nulls_last(d[0])):
            if choice == "skip":
                continue
            for a, b, _ in [*gold, *pred]:
                held.drop((a, b))
            new = {"gold": gold, "prediction": pred, "both": [*gold, *pred], "manual": (gold or pred)[:1]}.get(choice, [])
            for a, b, label in new:
                for span in held.meeting(a, b):
                    held.drop(span)
                held.put((a, b), (correct or label,))
        return held.spans

    return _replayed(docs, replay)


def apply_patches(spans: DataFrame, patches: DataFrame) -> DataFrame:
    """Replays accepted span patches in order of (reviewed_at, review_id): spans with a change column.

    patches: doc_id, review_id, reviewed_at, choice (accept, reject, modify),
    token_start, token_stop, label (O removes). A patch takes the place of all
    spans that it overlaps; one that finds its own result changes nothing, so
    a second replay is none.
    """

    def replay(mine: list[tuple], log: list[tuple]) -> dict:
        held = _Held({(a, b): (label, "kept") for a, b, label in mine})
        for _, _, choice, a, b, label in sorted(log, key=lambda p: _nulls_last(p[0], p[1])):
            if choice == "reject":
                continue
            if label != "O" and held.spans.get((a, b), ("",))[0] == label:
                continue
            gone = held.meeting(a, b)
            for s in gone:
                held.drop(s)
            if label != "O":
                held.put((a, b), (label, "replaced" if gone else "added"))
        return held.spans

    return _replayed(_gathered(spans, patches, "reviewed_at", "review_id", "choice", "token_start", "token_stop", "label"), replay, "change")


def patch_targets(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a change of tags asks for: new spans that touch a change, and O for old ones that vanished.

    Spans (doc_id, token_start, token_stop, label) before and after an edit.
    """
    side = lambda df, k: df.select(*SPAN, F.lit(k).alias("side"))
    return patch_targets_sides(together(side(before, 0), side(after, 1)))


def patch_targets_sides(both: DataFrame) -> DataFrame:
    """The same for spans before (side 0) and after (side 1) in one table.

    A vanished span meets a new one that begins before its end if the furthest
    end of these lies behind its start: a running maximum, no pairs.
    """
    changed = both.groupBy(*SPAN).agg(F.max("side").alias("side"), F.min("side").alias("least")).filter("side = least")
    at = F.when(F.col("side") == 1, F.col("token_start")).otherwise(F.col("token_stop"))
    earlier = W.partitionBy("doc_id").orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    rows = changed.withColumn("at", at).withColumn("reach", F.max(F.when(F.col("side") == 1, F.col("token_stop"))).over(earlier))
    kept = rows.filter((F.col("side") == 1) | F.coalesce(F.col("reach") <= F.col("token_start"), F.lit(True)))
    return kept.withColumn("label", F.when(F.col("side") == 1, F.col("label")).otherwise("O")).select(*SPAN)


def next_action(state: DataFrame) -> DataFrame:
    """The next step of a workflow from counts of what waits: suggest, review, split, promote, up to date, sample."""
    step = (
        F.when(F.col("sampled") == 0, "sample")
        .when(F.col("scored") < F.col("sampled"), "suggest")
        .when(F.col("waiting") > 0, "review")
        .when(F.col("accepted") > F.col("in_splits"), "split")
        .when(F.col("in_splits") > F.col("promoted"), "promote")
        .otherwise("up to date")
    )
    return state.withColumn("next_action", step)


def curation_reasons(rows: DataFrame, confidence: float = 0.9, margin: float = 0.5, several: float = 0.99, auto_accept: bool = False) -> DataFrame:
    """Why candidates (candidate_label, spans) need a review, in fixed order; without a reason they are auto_accepted."""
    target, spans = F.col("candidate_label"), F.col("spans")
    mine = F.filter(spans, lambda s: s["label"] == target)
    checked = F.when(target.isNotNull() & (F.size(mine) > 0), mine).otherwise(spans)
    best = F.array_max(F.transform(checked, lambda s: F.struct(s["confidence"].alias("c"), s["margin"].alias("m"), s["surface"].alias("s"))))
    sure = F.forall(spans, lambda s: (s["confidence"] >= several) & (s["margin"] >= margin))
    reasons = F.array(
        F.when(F.size(spans) == 0, "no_predicted_media_source_span"),
        F.when((F.size(spans) > 0) & target.isNotNull() & (F.size(mine) == 0), "predicted_label_differs_from_candidate"),
        F.when((F.size(spans) > 0) & target.isNull(), "missing_candidate_label"),
        F.when(best["c"] < confidence, "low_confidence"),
        F.when(best["m"] < margin, "low_margin"),
        F.when(F.lower(F.trim(best["s"])).isin("agence", "agentur", "agency", "ag."), "generic_surface_only"),
        F.when((F.size(spans) > 1) & ~sure, "multiple_predicted_spans"),
    )
    found = F.filter(reasons, lambda r: r.isNotNull())
    all_reasons = found if auto_accept else F.when(F.size(found) == 0, F.array(F.lit("manual_review_required"))).otherwise(found)
    return rows.withColumn("reasons", all_reasons).withColumn("status", F.when(F.size("reasons") == 0, "auto_accepted").otherwise("needs_review"))
