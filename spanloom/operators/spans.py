"""Joins, suppression and alignment of token spans. All joins are by document first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import json_object, json_string

from .tokens import own_deals, together

SPAN = ["doc_id", "token_start", "token_stop", "label"]


def _overlap(a: str, b: str) -> str:
    return f"{a}.doc_id = {b}.doc_id and {a}.token_start < {b}.token_stop and {b}.token_start < {a}.token_stop"


def _blocked(found: DataFrame, size: int = 32) -> DataFrame:
    """Each span in each block of tokens that it touches: adds ``first``, its first block, and ``block``."""
    number = lambda c: F.floor(c / size)
    rows = found.withColumn("first", number(F.col("token_start")))
    return rows.withColumn("block", F.explode(F.sequence("first", number(F.greatest(F.col("token_stop") - 1, F.col("token_start"))))))


def overlapping(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Pairs of overlapping spans under the aliases a and b; also left_semi and left_anti.

    Spans meet in the blocks of tokens that they share, not document by document;
    a pair counts where both are for the first time.
    """
    key = ["doc_id", "token_start", "token_stop"]
    near = f"a.block = b.block and {_overlap('a', 'b')}"
    if how == "inner":
        return _blocked(left).alias("a").join(_blocked(right).alias("b"), F.expr(f"{near} and a.block = greatest(a.first, b.first)"))
    if how not in ("left_semi", "left_anti"):
        raise ValueError(how)
    met = _blocked(left.select(*key)).alias("a").join(_blocked(right.select(*key)).alias("b"), F.expr(near), "left_semi").select(*key).distinct()
    return left.join(met, key, how).select(*left.columns)


def nearest(hits: DataFrame, gold: DataFrame) -> DataFrame:
    """Each hit with the best gold span: exact and same label, else the nearest edges of the same label, else of any that overlaps.

    Adds outcome (exact, overlap, label_conflict, false_positive), gold_label,
    gold_start, gold_stop. Ties go to the span that starts first.
    """
    keys = [f"a.{c}" for c in SPAN]
    gap = "abs(a.token_start - b.token_start) + abs(a.token_stop - b.token_stop)"
    tier = f"case when a.label = b.label and {gap} = 0 then 0 when a.label = b.label then 1 else 2 end"
    best = F.min(F.expr(f"struct({tier} as tier, {gap} as gap, b.token_start, b.token_stop, b.label)"))
    met = overlapping(hits.select(*SPAN).distinct(), gold.select(*SPAN).filter("label is not null")).groupBy(*keys).agg(best.alias("best"))
    outcome = F.element_at(F.array(*map(F.lit, ["exact", "overlap", "label_conflict", "false_positive"])), F.coalesce(F.col("best.tier"), F.lit(3)) + 1)
    rows = hits.join(met, SPAN, "left").withColumn("outcome", outcome)
    return rows.withColumns({"gold_label": F.col("best.label"), "gold_start": F.col("best.token_start"), "gold_stop": F.col("best.token_stop")}).drop("best")


def uncontained(found: DataFrame) -> DataFrame:
    """Without spans that a longer span of the same label holds.

    A longer one begins before and ends no earlier, or begins here and ends
    later: two running maxima tell, and no spans are paired.
    """
    before = W.partitionBy("doc_id", "label").orderBy("token_start").rangeBetween(W.unboundedPreceding, -1)
    here = W.partitionBy("doc_id", "label", "token_start")
    held = (F.max("token_stop").over(before) >= F.col("token_stop")) | (F.max("token_stop").over(here) > F.col("token_stop"))
    known = F.col("doc_id").isNotNull() & F.col("label").isNotNull()
    return found.withColumn("held", F.coalesce(known & held, F.lit(False))).filter("not held").drop("held")


def greedy(found: DataFrame) -> DataFrame:
    """Non-overlapping spans of each document: the longest first, then by confidence, margin and start.

    Spans that overlap are compared within their overlap component only: the
    array that a task folds holds one component, whatever the document's size.
    """
    parts = components(found.withColumn("side", F.lit(0)))
    order = F.struct(-(F.col("token_stop") - F.col("token_start")), -F.col("confidence"), -F.col("margin"), "token_start", "label", "token_stop")
    packed = parts.groupBy("doc_id", "component").agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "token_start", "token_stop", "label", "confidence", "margin"))).alias("spans"))
    none = F.slice("spans", 1, 0)
    clash = lambda kept, s: F.exists(kept, lambda k: (k["token_start"] < s["token_stop"]) & (s["token_start"] < k["token_stop"]))
    kept = F.aggregate("spans", none, lambda kept, s: F.when(clash(kept, s), kept).otherwise(F.concat(kept, F.array(s))))
    return packed.select("doc_id", F.explode(kept).alias("s")).select("doc_id", "s.token_start", "s.token_stop", "s.label", "s.confidence", "s.margin")


def merged_adjacent(found: DataFrame) -> DataFrame:
    """Touching spans of one label as one, with the least confidence and margin and the number of parts."""
    at = W.partitionBy("doc_id").orderBy("token_start", "token_stop", "label")
    new = ~F.coalesce((F.lag("token_stop").over(at) == F.col("token_start")) & (F.lag("label").over(at) == F.col("label")), F.lit(False))
    rows = found.withColumn("island", F.sum(new.cast("int")).over(at.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy("doc_id", "island").agg(F.min("token_start").alias("token_start"), F.max("token_stop").alias("token_stop"), F.first("label").alias("label"), F.min("confidence").alias("confidence"), F.min("margin").alias("margin"), F.count("*").alias("parts")).drop("island")


def components(found: DataFrame, among: Column | None = None) -> DataFrame:
    """Adds ``component``: spans of a document that overlap, directly or through others, share one. Rows that aren't ``among`` them have none."""
    at = W.partitionBy("doc_id").orderBy("token_start", "token_stop", "side", "label")
    among = F.lit(True) if among is None else among
    reach = F.max(F.when(among, F.col("token_stop"))).over(at.rowsBetween(W.unboundedPreceding, -1))
    new = among & ((F.col("token_start") >= reach) | reach.isNull())
    number = F.sum(F.col("new").cast("int")).over(at.rowsBetween(W.unboundedPreceding, 0))
    return found.withColumn("new", new).withColumn("component", F.when(among, number)).drop("new")


def aligned(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Outcomes of predicted against gold spans: doc_id, outcome, token_start, token_stop, gold, predicted (labels).

    Exact matches are ``correct``; the rest falls into overlap components:
    missed, extra, wrong_label, span_mismatch, wrong_label_and_span (one of
    each) or complex_overlap.
    """
    return aligned_sides(together(gold.select(*SPAN).distinct().withColumn("side", F.lit(0)), predicted.select(*SPAN).distinct().withColumn("side", F.lit(1))))


def aligned_sides(both: DataFrame, places: bool = False) -> DataFrame:
    """The same for spans of both sides in one table, where side is 0 for gold and 1 for predicted.

    An exact pair is a group of its own, so all outcomes come from one grouping.
    With ``places`` also g and p, both sides' spans in order.
    """
    both = both.withColumn("sides", F.count("*").over(W.partitionBy(*SPAN)))
    span = F.struct("token_start", "token_stop", "label")
    rows = components(both, F.col("sides") == 1).withColumn("exact", F.when(F.col("sides") == 2, span))
    of = lambda side, value: F.sort_array(F.collect_list(F.when(F.col("side") == side, value)))
    parts = rows.groupBy("doc_id", "component", "exact").agg(of(0, span).alias("g"), of(1, span).alias("p"), F.min("token_start").alias("token_start"), F.max("token_stop").alias("token_stop"))
    same_place = (F.col("g")[0]["token_start"] == F.col("p")[0]["token_start"]) & (F.col("g")[0]["token_stop"] == F.col("p")[0]["token_stop"])
    same_label = F.col("g")[0]["label"] == F.col("p")[0]["label"]
    outcome = (
        F.when(F.size("g") == 0, F.lit("extra"))
        .when(F.size("p") == 0, F.lit("missed"))
        .when((F.size("g") > 1) | (F.size("p") > 1), F.lit("complex_overlap"))
        .when(same_place & same_label, F.lit("correct"))
        .when(same_place, F.lit("wrong_label"))
        .when(same_label, F.lit("span_mismatch"))
        .otherwise(F.lit("wrong_label_and_span"))
    )
    labels = lambda side: F.transform(side, lambda s: s["label"])
    kept = ["g", "p"] if places else []
    return parts.select("doc_id", outcome.alias("outcome"), "token_start", "token_stop", labels("g").alias("gold"), labels("p").alias("predicted"), *kept)


def disagreements(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Review items of components without an exact match: doc_id, kind, token_start, token_stop, gold, predicted, review_id."""
    return disagreeing(aligned(gold, predicted))


def disagreeing(outcomes: DataFrame) -> DataFrame:
    """The review items of alignment outcomes."""
    rows = outcomes.filter("outcome <> 'correct'")
    kind = F.when(F.col("outcome") == "extra", F.lit("extra_prediction")).when(F.col("outcome") == "missed", F.lit("missing_prediction")).when(F.col("outcome") == "wrong_label", F.lit("label_mismatch")).otherwise(F.lit("span_or_label_mismatch"))
    text = F.concat_ws("\t", F.col("doc_id").cast("string"), "kind", F.col("token_start").cast("string"), F.col("token_stop").cast("string"), F.array_join("gold", ","), F.array_join("predicted", ","))
    return rows.withColumn("kind", kind).select("doc_id", "kind", "token_start", "token_stop", "gold", "predicted", F.substring(F.sha1(text), 1, 16).alias("review_id"))


def review_ids(outcomes: DataFrame, split: Column) -> DataFrame:
    """Review items of alignment outcomes with ``review_id``: the split, the document and a digest of the item as canonical JSON.

    ``outcomes`` as from ``aligned_sides`` with places: g and p hold the spans
    of both sides. An item of one span a side at most names ``gold`` and
    ``prediction``; one of more names lists of spans.
    """
    kind = F.when(F.col("outcome") == "extra", "extra_prediction").when(F.col("outcome") == "missed", "missing_prediction").when(F.col("outcome") == "wrong_label", "label_mismatch").otherwise("span_or_label_mismatch")
    span = lambda s: json_object(token_start=s["token_start"].cast("string"), token_stop=s["token_stop"].cast("string"), label=json_string(s["label"]))
    first = lambda side: F.when(F.size(side) > 0, span(F.col(side)[0]))
    every = lambda side: F.concat(F.lit("["), F.array_join(F.transform(side, span), ","), F.lit("]"))
    rows = outcomes.filter("outcome <> 'correct'").withColumns({"kind": kind, "split": split, "doc": F.col("doc_id").cast("string")})
    common = {"split": json_string(F.col("split")), "doc_id": json_string(F.col("doc")), "issue_type": json_string(F.col("kind"))}
    one = json_object(**common, gold=first("g"), prediction=first("p"))
    many = json_object(**common, gold_spans=every("g"), prediction_spans=every("p"))
    payload = F.when((F.size("g") <= 1) & (F.size("p") <= 1), one).otherwise(many)
    return rows.select("doc_id", "kind", "split", "token_start", "token_stop", F.concat_ws(":", "split", "doc", F.substring(F.sha1(payload), 1, 16)).alias("review_id"))


def to_tokens(spans: DataFrame, tokens: DataFrame) -> DataFrame:
    """Character spans (doc_id, start, stop, label) to token spans; ``aligned`` says whether both edges are token edges."""
    own_deals(spans.sparkSession)
    edges = lambda *more: F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(c).cast("long").alias("at"), *more) for side, c in enumerate(("start", "stop"))])).alias("e")
    # both edges of a span meet the tokens in one pass, which streams past the spans
    rows = spans.withColumn("_row", F.monotonically_increasing_id()).select("doc_id", "_row", F.struct(*spans.columns).alias("span"), edges()).select("doc_id", "_row", "span", "e.*")
    ends = tokens.select("doc_id", "i", edges()).select("doc_id", "i", "e.*")
    met = rows.hint("shuffle_hash").join(ends, ["doc_id", "side", "at"], "left").groupBy("doc_id", "_row")
    met = met.agg(F.first("span").alias("span"), F.max(F.when(F.col("side") == 0, F.col("i"))).alias("token_start"), F.max(F.when(F.col("side") == 1, F.col("i") + 1)).alias("token_stop"))
    kept = [F.col("doc_id" if c == "doc_id" else f"span.{c}") for c in spans.columns]  # the key itself tells Spark that the rows are dealt by it
    return met.select(*kept, "token_start", "token_stop", (F.col("token_start").isNotNull() & F.col("token_stop").isNotNull()).alias("aligned"))


def without_equal(found: DataFrame, others: DataFrame) -> DataFrame:
    """Spans whose edges no span of ``others`` has."""
    return found.join(others.select("doc_id", "token_start", "token_stop").distinct(), ["doc_id", "token_start", "token_stop"], "left_anti")


def merged_sources(found: DataFrame) -> DataFrame:
    """Equal spans as one, with their distinct sources in order of ``ord``."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ord", "source"))), lambda x: x["source"])
    return found.groupBy(*SPAN).agg(F.array_distinct(ordered).alias("sources"))


def edge_suggestions(spans: DataFrame, lengths: DataFrame, reach: int = 2, most: int = 10) -> DataFrame:
    """Spans whose edges lie within ``reach`` tokens of a span's, by distance, growth to the left and width; the first ``most``."""
    moves = F.sequence(F.lit(-reach), F.lit(reach))
    rows = spans.select(*SPAN, F.explode(moves).alias("l")).select("*", F.explode(moves).alias("r")).join(lengths, "doc_id")
    rows = rows.withColumn("new_start", F.col("token_start") + F.col("l")).withColumn("new_stop", F.col("token_stop") + F.col("r"))
    rows = rows.filter("(l <> 0 or r <> 0) and new_start >= 0 and new_stop <= n and new_start < new_stop")
    at = W.partitionBy(*SPAN).orderBy(F.abs("l") + F.abs("r"), F.greatest(-F.col("l"), F.lit(0)), F.col("new_stop") - F.col("new_start"), "new_start", "new_stop")
    return rows.withColumn("rank", F.row_number().over(at)).filter(F.col("rank") <= most).select(*SPAN, "new_start", "new_stop", "rank")
