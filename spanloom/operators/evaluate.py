"""Metrics of tags and spans, decoders over log probabilities, and reports of runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import base_label, f1, ratio

from .spans import SPAN
from .tokens import together


def _scores(rows: DataFrame, *keys: str) -> DataFrame:
    p, r = ratio(F.col("correct"), F.col("predicted")), ratio(F.col("correct"), F.col("gold"))
    return rows.select(*keys, "correct", "gold", "predicted", p.alias("precision"), r.alias("recall"), f1(p, r).alias("f1"))


def token_metrics(tagged: DataFrame, gold: str = "gold", predicted: str = "predicted") -> DataFrame:
    """Accuracy and non-O precision, recall and F1 of tags, in one pass."""
    count = lambda c: F.sum(c.cast("long"))
    g, p = F.col(gold), F.col(predicted)
    sums = tagged.agg(F.count("*").alias("tokens"), count(g == p).alias("equal"), count((g == p) & (g != "O")).alias("correct"), count(g != "O").alias("gold"), count(p != "O").alias("predicted"))
    sums = sums.select("tokens", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("equal", "correct", "gold", "predicted")])
    return _scores(sums.withColumn("accuracy", ratio(F.col("equal"), F.col("tokens"))), "tokens", "accuracy")


def _matched(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Distinct spans of either side with flags; one grouping instead of a join."""
    side = lambda df, g: df.select(*SPAN, F.lit(g).alias("g"), F.lit(1 - g).alias("p"))
    return together(side(gold, 1), side(predicted, 0)).groupBy(*SPAN).agg(F.max("g").alias("g"), F.max("p").alias("p"))


def entity_metrics(gold: DataFrame, predicted: DataFrame, by_label: bool = False) -> DataFrame:
    """Exact-match precision, recall and F1 of spans, over all or by label."""
    return matched_metrics(_matched(gold, predicted), by_label)


def sided_metrics(both: DataFrame, by_label: bool = False) -> DataFrame:
    """The same for spans of both sides in one table, where side is 0 for gold and 1 for predicted."""
    flags = both.groupBy(*SPAN).agg(F.max((F.col("side") == 0).cast("int")).alias("g"), F.max("side").alias("p"))
    return matched_metrics(flags, by_label)


def matched_metrics(matched: DataFrame, by_label: bool) -> DataFrame:
    keys = ["label"] if by_label else []
    long = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = matched.groupBy(*keys).agg(long(F.col("g") * F.col("p")).alias("correct"), long(F.col("g")).alias("gold"), long(F.col("p")).alias("predicted"))
    return _scores(sums, *keys)


def outcome_counts(outcomes: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts of all outcomes, zeros included."""
    every = outcomes.sparkSession.createDataFrame([(k,) for k in kinds], "outcome string")
    return every.join(outcomes.groupBy("outcome").agg(F.count("*").alias("n")), "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))


def outcomes_by_label(outcomes: DataFrame, kinds: list[str]) -> DataFrame:
    """Outcomes of each gold label, a column for each kind; components count once for each gold span."""
    each = outcomes.select(F.explode("gold").alias("label"), "outcome")
    return each.groupBy("label").pivot("outcome", kinds).count().na.fill(0)


def alias_quality(judged: DataFrame) -> DataFrame:
    """Hits of each alias by outcome, with strict and lenient precision to 4 places."""
    count = lambda *kinds: F.sum(F.col("outcome").isin(*kinds).cast("long"))
    sums = judged.groupBy("label", "alias").agg(F.count("*").alias("hits"), count("exact").alias("exact"), count("overlap").alias("overlap"), count("label_conflict").alias("conflict"), count("false_positive").alias("false_positive"))
    return sums.withColumn("precision_exact", F.bround(ratio(F.col("exact"), F.col("hits")), 4)).withColumn("precision_lenient", F.bround(ratio(F.col("exact") + F.col("overlap"), F.col("hits")), 4))


def coverage_level(n: Column) -> Column:
    return F.when(n >= 20, "adequate").when(n >= 10, "limited").otherwise("insufficient")


def run_aggregate(runs: DataFrame, *keys: str) -> DataFrame:
    """Seeds of a cell: count, mean, sample deviation (0 for one), least and greatest value."""
    return runs.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("stdev"), F.min("value").alias("low"), F.max("value").alias("high"))


def paired_deltas(runs: DataFrame, baseline: str) -> DataFrame:
    """value(cell) - value(baseline) of equal seeds, and a row with seed null for their mean."""
    base = runs.filter(F.col("cell") == baseline).select("seed", F.col("value").alias("before"))
    deltas = runs.filter(F.col("cell") != baseline).join(base, "seed").select("cell", "seed", (F.col("value") - F.col("before")).alias("delta"))
    return deltas.unionByName(deltas.groupBy("cell").agg(F.avg("delta").alias("delta")).select("cell", F.lit(None).cast("int").alias("seed"), "delta"))


def label_sets(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Labels of either side with where they occur."""
    a = ours.select("label").distinct().withColumn("a", F.lit(True))
    b = theirs.select("label").distinct().withColumn("b", F.lit(True))
    where = F.when(F.col("a").isNull(), "checkpoint_only").when(F.col("b").isNull(), "dataset_only").otherwise("shared")
    return a.join(b, "label", "full_outer").select("label", where.alias("found_in"))


# decoders


def argmax_decode(emissions: DataFrame, labels: list[str], scores: str = "scores") -> DataFrame:
    """The first best label of each position."""
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    return emissions.withColumn("tag", F.element_at(F.array(*map(F.lit, labels)), best))


def allowed(before: str | None, tag: str) -> bool:
    """Whether ``tag`` may follow: I needs a span of its type before, and B may not follow a span of its own type."""
    same = before is not None and before[2:] == tag[2:] and before != "O"
    if tag.startswith("I-"):
        return same
    return not (tag.startswith("B-") and same)


def viterbi(scores: np.ndarray, labels: list[str]) -> list[int]:
    """Best allowed sequence for (positions, labels) log scores; of equal ones that with the lowest label ids from the end."""
    if not len(scores):
        return []
    move = np.array([[0.0 if allowed(a, b) else -np.inf for b in labels] for a in labels])
    best = scores[0] + np.array([0.0 if allowed(None, b) else -np.inf for b in labels])
    back = []
    for row in scores[1:]:
        reach = best[:, None] + move
        back.append(reach.argmax(0))
        best = reach.max(0) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def viterbi_decode(emissions: DataFrame, labels: list[str]) -> DataFrame:
    """(doc_id, scores: array of positions of label scores) to doc_id, tags; documents without positions have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = [[labels[k] for k in viterbi(np.array(s, float).reshape(-1, len(labels)), labels)] if s else [] for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tags, pa.list_(pa.string()))], names=["doc_id", "tags"])

    kind = emissions.schema["doc_id"].dataType.simpleString()
    return emissions.select("doc_id", "scores").mapInArrow(run, f"doc_id {kind}, tags array<string>")


def score_windows(windows: DataFrame, labels: list[str]) -> DataFrame:
    """Tags of whole documents from log probabilities of windows that overlap: doc_id, i, tag, confidence.

    ``windows``: doc_id, window, low (its first word), scores (an array of
    labels' log probabilities for each word). A word's scores are those of its
    first window. Windows reach their task in order, and the decoder's state is
    carried from one to the next, so what a document needs beside one window are
    its back pointers. The confidence is the probability of the tag's label, B
    and I together. A word that no window covers stops the job. Null or empty
    scores are no words; documents without words have no rows.
    """
    kind = windows.schema["doc_id"].dataType.simpleString()
    move = np.array([[0.0 if allowed(a, b) else -np.inf for b in labels] for a in labels])
    first = np.array([0.0 if allowed(None, b) else -np.inf for b in labels])
    same = np.array([[float(a == b or (a != "O" and b != "O" and a[2:] == b[2:])) for b in labels] for a in labels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, best = None, None
        back: list[np.ndarray] = []
        sure: list[np.ndarray] = []

        def ended() -> Iterator[pa.RecordBatch]:
            if best is None:
                return
            at = int(best.argmax())
            path = [at]
            for row in reversed(back):
                path.append(at := int(row[at]))
            path.reverse()
            chance = np.concatenate(sure)[np.arange(len(path)), path]
            yield pa.RecordBatch.from_arrays([pa.array([doc] * len(path), id_type), pa.array(np.arange(len(path), dtype=np.int32)), pa.array([labels[k] for k in path]), pa.array(chance)], names=["doc_id", "i", "tag", "confidence"])

        for batch in batches:
            id_type = batch.column(0).type
            for name, low, scores in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if name != doc:
                    yield from ended()
                    doc, best, back, sure = name, None, [], []
                done = len(back) + (best is not None)
                if scores and low > done:
                    raise ValueError(f"no window covers word {done} of {doc}")
                fresh = np.array((scores or [])[done - low :], float).reshape(-1, len(labels))
                sure.append(np.exp(fresh) @ same)
                for row in fresh:
                    if best is None:
                        best = first + row
                        continue
                    reach = best[:, None] + move
                    back.append(reach.argmax(0).astype(np.uint8))
                    best = reach.max(0) + row
        yield from ended()

    dealt = windows.select("doc_id", "window", F.col("low").cast("int").alias("low"), "scores").repartition("doc_id").sortWithinPartitions("doc_id", "window")
    return dealt.mapInArrow(run, f"doc_id {kind}, i int, tag string, confidence double")


def word_emissions(subtokens: DataFrame, labels: list[str], every: bool) -> DataFrame:
    """Scores of words from those of their subtokens: the first's, or sums in which a B goes on as I.

    (doc_id, word, sub, scores) to doc_id, word, scores.
    """
    if not every:
        return subtokens.groupBy("doc_id", "word").agg(F.min_by("scores", "sub").alias("scores"))
    index = {t: k for k, t in enumerate(labels)}
    onward = F.array(*[F.get("scores", F.lit(index.get("I" + t[1:], k) if t.startswith("B-") else k)) for t, k in index.items()])
    at = W.partitionBy("doc_id", "word")
    own = F.when(F.col("sub") == F.min("sub").over(at), F.col("scores")).otherwise(onward)
    rows = subtokens.withColumn("own", own)
    return rows.groupBy("doc_id", "word").agg(F.array(*[F.sum(F.get("own", F.lit(k))) for k in range(len(labels))]).alias("scores"))


def subtoken_labels(words: DataFrame, every: bool, ignore: int = -100) -> DataFrame:
    """Label ids for subtokens (sub, tag, id, inside_id): of the first, or of all with B going on as I; else ``ignore``."""
    rest = F.when(F.col("tag").startswith("B-"), F.col("inside_id")).otherwise(F.col("id")) if every else F.lit(ignore)
    return words.withColumn("target", F.when(F.col("sub") == 0, F.col("id")).otherwise(rest))


def expansion_pattern(tags: Column) -> Column:
    """The kind of a word's subtoken tags in order."""
    bases = F.array_distinct(F.transform(F.filter(tags, lambda t: t != "O"), base_label))
    first, rest = F.get(tags, 0), F.slice(tags, 2, F.greatest(F.size(tags), F.lit(1)))
    whole = F.size(F.filter(tags, lambda t: t == "O")) == 0
    inside = F.forall(rest, lambda t: t.startswith("I-"))
    return (
        F.when(F.size(bases) == 0, "all_O")
        .when(F.size(bases) > 1, "mixed_entity_types")
        .when(first == "O", "first_O_continuation_entity")
        .when(~whole, "internal_O")
        .when(first.startswith("B-") & inside, "valid_B")
        .when(first.startswith("I-") & inside, "valid_I")
        .otherwise("invalid_bio_shape")
    )


def label_margin(log_probs: Column, labels: list[str], label: str) -> Column:
    """Probability of a label, B and I together, less that of the best other one, O included."""
    groups: dict[str, list[int]] = {}
    for k, t in enumerate(labels):
        groups.setdefault(t if t == "O" else t[2:], []).append(k)
    p = {g: sum((F.exp(F.get(log_probs, F.lit(k))) for k in ks[1:]), F.exp(F.get(log_probs, F.lit(ks[0])))) for g, ks in groups.items()}
    others = [v for g, v in p.items() if g != label]
    return p[label] - (F.greatest(*others) if len(others) > 1 else others[0])


def suggested_tag(log_probs: Column, labels: list[str], least: float = 0.33) -> Column:
    """The best tag; where that is O, the best other one with at least so much probability."""
    scored = F.array(*[F.struct(F.get(log_probs, F.lit(k)).alias("p"), F.lit(-k).alias("k"), F.lit(t).alias("t")) for k, t in enumerate(labels)])
    best, other = F.array_max(scored), F.array_max(F.filter(scored, lambda s: s["t"] != "O"))
    return F.when((best["t"] == "O") & (F.exp(other["p"]) > least), other["t"]).otherwise(best["t"])


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """First difference of two runs' tokens (doc_id, i, token, tag) by document: doc_id, kind, i."""
    a = left.select("doc_id", "i", F.col("token").alias("ta"), F.col("tag").alias("la"))
    b = right.select("doc_id", "i", F.col("token").alias("tb"), F.col("tag").alias("lb"))
    return first_differences(a.join(b, ["doc_id", "i"], "full_outer"))


def first_differences(both: DataFrame) -> DataFrame:
    """The same for both runs' tokens (ta, tb) and tags (la, lb) side by side."""
    kind = F.when(F.col("ta").isNull() | F.col("tb").isNull(), "missing_token").when(F.col("ta") != F.col("tb"), "token").when(F.col("la") != F.col("lb"), "label")
    return both.withColumn("kind", kind).filter("kind is not null").groupBy("doc_id").agg(F.min_by("kind", "i").alias("kind"), F.min("i").alias("i"))


def transitions(labels: list[str]) -> list[tuple[str, str]]:
    """Allowed pairs of labels, for checks."""
    return [(a, b) for a in labels for b in labels if allowed(a, b)]
