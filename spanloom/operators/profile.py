"""Counts that describe a corpus: splits, surfaces, coverage and lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLITS = ["train", "validation", "test"]
#: Shares that a key's forms are ranked in before they meet.
SHARES = 64


def split_statistics(docs: DataFrame) -> DataFrame:
    """Documents, annotated ones, tokens, mentions, sources and dates of each split, all three listed.

    (split, n_tokens, n_mentions, source, date): dates are compared as text of
    10 characters; empty sources don't count.
    """
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    day = F.substring("date", 1, 10)
    found = docs.groupBy("split").agg(F.count("*").alias("documents"), F.sum((F.col("n_mentions") > 0).cast("long")).alias("annotated"), F.sum("n_tokens").alias("tokens"), F.sum("n_mentions").alias("mentions"), F.count_distinct(F.when(F.col("source") != "", F.col("source"))).alias("sources"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    every = docs.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return every.join(found, "split", "left").select("split", *[long(F.col(c)).alias(c) for c in ("documents", "annotated", "tokens", "mentions", "sources")], "first_day", "last_day")


def by_split(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each value of ``key`` by split, with a total."""
    counts = rows.groupBy(key).pivot("split", SPLITS).count().na.fill(0)
    return counts.withColumn("total", sum((F.col(s) for s in SPLITS[1:]), F.col(SPLITS[0])))


def top_surfaces(mentions: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Most frequent normalised surfaces (form, surface, ord) of each key: form, n, share, display, rank.

    Equal counts go by first occurrence; display is the most frequent raw form.
    """
    raw = mentions.groupBy(*keys, "form", "surface").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    forms = raw.groupBy(*keys, "form").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max_by("surface", F.struct("n", -F.col("first"))).alias("display"))
    # a key may hold most forms: they are ranked and added up in shares, of which the first row tells the sum
    order = (F.desc("n"), "first", "form")
    shares = forms.withColumn("share", F.pmod(F.xxhash64("form"), F.lit(SHARES)))
    shares = shares.withColumns({"k": F.row_number().over(W.partitionBy(*keys, "share").orderBy(*order)), "held": F.sum("n").over(W.partitionBy(*keys, "share"))}).filter(F.col("k") <= top)
    ranked = shares.withColumns({"rank": F.row_number().over(W.partitionBy(*keys).orderBy(*order)), "total": F.sum(F.when(F.col("k") == 1, F.col("held"))).over(W.partitionBy(*keys))})
    return ranked.filter(F.col("rank") <= top).select(*keys, "form", "n", F.bround(F.col("n") / F.col("total"), 4).alias("share"), "display", "rank")


def surface_forms(mentions: DataFrame, keys: list[str], examples: int, form: Column | None = None) -> DataFrame:
    """All raw forms of each surface, most frequent first, and the first examples (doc_id) that show it.

    Mentions have a ``form``, or ``form`` makes it of ``surface``: once for each
    distinct one, not for each mention.
    """
    known = ["form"] if form is None else []
    made = lambda df: df if form is None else df.withColumn("form", form)
    raw = made(mentions.groupBy(*keys, *known, "surface").agg(F.count("*").alias("n"), F.min("ord").alias("first")))
    forms = raw.groupBy(*keys, "form").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "surface"))), lambda s: s["surface"]).alias("forms"), F.sum("n").alias("n"))
    at_most = lambda df, *by: df.withColumn("k", F.row_number().over(W.partitionBy(*keys, *by).orderBy("ord"))).filter(F.col("k") <= examples)
    shown = at_most(made(at_most(mentions, *known, "surface")), "form")
    shown = shown.groupBy(*keys, "form").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "doc_id"))), lambda s: s["doc_id"]).alias("examples"))
    return forms.join(shown, [*keys, "form"])


def coverage(counts: DataFrame, labels: DataFrame, languages: list[str], main: set[str], pending: DataFrame, main_target: int = 20, side_target: int = 5) -> DataFrame:
    """The dense grid of labels and languages: total, target, missing, pending.

    Labels of ``labels``, counts and pending all appear. The grid is the cross
    product of a label list and a language list, not of data.
    """
    universe = labels.select("label").unionByName(counts.select("label")).unionByName(pending.select("label")).distinct()
    grid = universe.select("label", F.explode(F.array(*map(F.lit, languages))).alias("language"))
    target = F.when(F.col("language").isin(*main), F.lit(main_target)).otherwise(F.lit(side_target))
    total = counts.groupBy("label", "language").agg(F.sum("n").alias("total"))
    waiting = pending.groupBy("label", "language").agg(F.sum("n").alias("pending"))
    rows = grid.join(total, ["label", "language"], "left").join(waiting, ["label", "language"], "left")
    have, wait = F.coalesce("total", F.lit(0)).cast("long"), F.coalesce("pending", F.lit(0)).cast("long")
    return rows.select("label", "language", have.alias("total"), target.cast("long").alias("target"), F.greatest(target - have, F.lit(0)).cast("long").alias("missing"), wait.alias("pending"))


def percentiles(values: DataFrame, column: str, keys: list[str], fractions: dict[str, float]) -> DataFrame:
    """Values at the lower index int(f * (n - 1)), the greatest value and the mean to 3 places.

    Ranks come from counts of distinct values, so a task holds values and not rows.
    """
    hist = values.groupBy(*keys, column).agg(F.count("*").alias("k"))
    at = W.partitionBy(*keys).orderBy(column)
    hist = hist.withColumn("upto", F.sum("k").over(at.rowsBetween(W.unboundedPreceding, 0))).withColumn("n", F.sum("k").over(W.partitionBy(*keys)))
    index = lambda f: F.floor(F.lit(f) * (F.col("n") - 1))
    picks = [F.min(F.when(F.col("upto") > index(f), F.col(column))).alias(name) for name, f in fractions.items()]
    total = F.sum(F.col(column) * F.col("k"))
    return hist.groupBy(*keys).agg(*picks, F.max(column).alias("most"), F.max("n").alias("n"), (total / F.max("n")).alias("mean"))


def top_labels(gold: DataFrame, predicted: DataFrame, k: int) -> DataFrame:
    """The k most frequent labels of either side; ties by label."""
    both = gold.select("label", F.lit("gold").alias("side")).unionByName(predicted.select("label", F.lit("predicted").alias("side")))
    counts = both.groupBy("side", "label").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(W.partitionBy("side").orderBy(F.desc("n"), "label"))).filter(F.col("rank") <= k)


def long_counts(rows: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Several counts in one pass as (metric, key, value): each metric's key column is grouped by itself."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), key.cast("string").alias("key")) for name, key in metrics.items()]))
    return rows.select(pairs.alias("p")).filter("p.key is not null").groupBy("p.metric", "p.key").agg(F.count("*").alias("value"))
