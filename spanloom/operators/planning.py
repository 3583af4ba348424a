"""Plans and draws of samples, and splits that keep groups together."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import casefold, generic_surface
from spanloom.sources.scratch import work_folder

from .sets import numbered
from .tokens import hinted


def sampling_plan(grid: DataFrame, aliases: DataFrame, seen: DataFrame, target: int, saturation: int) -> tuple[DataFrame, DataFrame]:
    """Queries that fill coverage gaps, and the gaps that none fills.

    ``grid`` as of ``profile.coverage``; ``aliases`` (label, language, query);
    ``seen`` (label, language, form, n). Generic queries count only where there
    is no other. Skipped buckets have a reason: pending_work_fills_gap, no_query_alias.
    """
    gaps = grid.filter("missing > 0").withColumn("open", F.greatest(F.col("missing") - F.col("pending"), F.lit(0)))
    form = casefold(F.col("query"))
    ranked = aliases.withColumns({"form": form, "generic": generic_surface(F.col("query"))})
    ranked = ranked.join(seen.select("label", "language", "form", F.col("n").alias("surface_count")), ["label", "language", "form"], "left").withColumn("surface_count", F.coalesce("surface_count", F.lit(0)))
    priority = F.when(F.col("generic"), 20).when(F.col("surface_count") >= saturation, 60).otherwise(100)
    useful = F.max((~F.col("generic")).cast("int")).over(W.partitionBy("label", "language"))
    ranked = ranked.withColumn("priority", priority).withColumn("useful", useful).filter("not generic or useful = 0")
    rows = gaps.filter("open > 0").join(ranked, ["label", "language"]).select("label", "language", "query", "missing", "pending", F.least(F.lit(target).cast("long"), F.col("open")).alias("planned_new"), "surface_count", "priority")
    none = gaps.filter("open > 0").join(ranked.select("label", "language").distinct(), ["label", "language"], "left_anti")
    reason = lambda df, why: df.select("label", "language", "missing", "pending", F.lit(why).alias("reason"))
    return rows, reason(gaps.filter("open = 0"), "pending_work_fills_gap").unionByName(reason(none, "no_query_alias"))


def holdout_gaps(counts: DataFrame, aliases: DataFrame, minimum: int, factor: float = 1.5, most: int = 3) -> DataFrame:
    """How many candidates each of a label's first aliases shall find for its held-out splits.

    ``counts`` (label, validation, test). The need grows by ``factor`` and is
    spread evenly, rounded up, until nothing remains.
    """
    need = F.greatest(minimum - F.col("validation"), F.lit(0)) + F.greatest(minimum - F.col("test"), F.lit(0))
    rows = counts.withColumn("needed", need).filter("needed > 0").withColumn("planned", F.ceil(F.col("needed") * F.lit(factor)))
    first = aliases.withColumn("r", F.row_number().over(W.partitionBy("label").orderBy("ord"))).filter(F.col("r") <= most).withColumn("k", F.count("*").over(W.partitionBy("label")))
    share = F.ceil(F.col("planned") / F.col("k"))
    out = rows.join(first, "label").withColumn("planned_new", F.greatest(F.lit(0), F.least(share, F.col("planned") - share * (F.col("r") - 1))))
    return out.filter("planned_new > 0").select("label", "alias", "r", "needed", "planned", "planned_new")


def balanced_selection(rows: DataFrame, buckets: list[str], order: list[str], per_bucket: int, per_label: int) -> DataFrame:
    """Round robin over a label's buckets: each round the next row of each bucket, up to the caps.

    Rows must have distinct issues within a label; then a rank replaces the loop.
    """
    at = W.partitionBy(*buckets).orderBy(*order)
    ranked = rows.withColumn("turn", F.row_number().over(at)).filter(F.col("turn") <= per_bucket)
    place = F.row_number().over(W.partitionBy("label").orderBy("turn", *[b for b in buckets if b != "label"], *order))
    return ranked.withColumn("place", place).filter(F.col("place") <= per_label)


def balanced_selection_by_issue(rows: DataFrame, buckets: list[str], order: list[str], per_bucket: int, per_label: int) -> DataFrame:
    """The same for rows whose issues repeat: a label takes an issue once.

    Of an issue's rows in a bucket only the first can be taken, and of a bucket
    no more than its first ``per_label`` issues, since a label takes no more; so
    a label's candidates are cut to these before they meet in one group.
    """
    others = [b for b in buckets if b != "label"]
    schema = rows.schema
    for keys, most in (([*buckets, "issue"], 1), (buckets, per_label)):
        rows = rows.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_k") <= most).drop("_k")

    def draw(pool: pd.DataFrame) -> pd.DataFrame:
        queues = [iter(list(g.index)) for _, g in pool.sort_values([*others, *order], kind="stable").groupby(others, sort=True)]
        taken, issues, counts = [], set(), [0] * len(queues)
        alive = True
        while alive and len(taken) < per_label:
            alive = False
            for k, queue in enumerate(queues):
                if counts[k] >= per_bucket or len(taken) >= per_label:
                    continue
                row = next((i for i in queue if pool.at[i, "issue"] not in issues), None)
                if row is not None:
                    issues.add(pool.at[row, "issue"])
                    taken.append(row)
                    counts[k] += 1
                    alive = True
        return pool.loc[taken]

    return rows.groupBy("label").applyInPandas(draw, schema)


def group_order(seed: int, group: Column) -> Column:
    return F.sha1(F.concat(F.lit(f"{seed}\t"), group))


def group_split(groups: DataFrame, seed: int = 42, test: float = 0.15, validation: float = 0.15) -> DataFrame:
    """(grp) to grp, split: groups in the order of a seeded hash, first the test ones, then validation, the rest train.

    Each held-out split has one group at least and train keeps one. Groups are
    counted and ranked by the hash's first three digits, so no task sees all.
    """
    rows = groups.select("grp").distinct().withColumn("h", group_order(seed, F.col("grp").cast("string"))).withColumn("digits", F.substring("h", 1, 3))
    counts = rows.groupBy("digits").agg(F.count("*").alias("many"))  # 4,096 rows at most
    before = counts.select("digits", (F.sum("many").over(W.orderBy("digits")) - F.col("many")).alias("before"), F.sum("many").over(W.partitionBy()).alias("n"))
    rank = F.row_number().over(W.partitionBy("digits").orderBy("h", "grp")) + F.col("before")
    rows = rows.join(F.broadcast(before), "digits").select("grp", rank.alias("r"), "n")
    tests = F.greatest(F.lit(1), F.ceil(F.col("n") * test))
    held = F.least(F.greatest(F.lit(1), F.ceil(F.col("n") * validation)), F.greatest(F.col("n") - tests - 1, F.lit(0)))
    split = F.when(F.col("n") == 1, "train").when(F.col("r") <= tests, "test").when(F.col("r") <= tests + held, "validation").otherwise("train")
    return rows.select("grp", split.alias("split"))


def split_conflicts(kept: DataFrame) -> DataFrame:
    """Groups (grp, split) that stand in several splits: grp, splits (comma-joined, in order)."""
    found = kept.groupBy("grp").agg(F.array_sort(F.collect_set("split")).alias("s"))
    return found.filter("size(s) > 1").select("grp", F.array_join("s", ",").alias("splits"))


def deficit_split(benefit: DataFrame, minimum: int, seed: int = 42, frontier: int = 1000, kept: DataFrame | None = None, held: DataFrame | None = None) -> DataFrame:
    """(grp, label, n) to grp, split: groups that cover most of what test, then validation, lack go there first.

    A greedy choice; equal gains go by a seeded hash, and groups that aren't
    chosen have a null split, for ``group_split``. Groups of ``kept`` (grp,
    split) keep their split; one in several splits stops the job, and
    ``split_conflicts`` names it. What the splits hold already (``held``: split,
    label, n) is taken off what they lack.

    A group's gain only falls as others are chosen, so of all groups the
    ``frontier`` best are fetched, and chosen from as long as none outside can be
    better; then the gains of the rest are computed anew, from counts that are
    stored once. The driver holds the frontier, the labels and the choices,
    which are as few as the splits lack mentions.
    """
    spark = benefit.sparkSession
    kind = benefit.schema["grp"].dataType.simpleString()
    path = work_folder(spark, "counts")
    benefit.groupBy("grp", "label").agg(F.sum("n").alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    fixed = spark.createDataFrame([], f"grp {kind}, split string") if kept is None else kept.select("grp", "split").distinct()
    if kept is not None and (bad := split_conflicts(kept).orderBy("grp").limit(5).collect()):
        raise ValueError("groups in several splits: " + "; ".join(f"{r['grp']}: {r['splits']}" for r in bad))
    labels = [r["label"] for r in counts.select("label").distinct().collect()]
    has = {} if held is None else {(r["split"], r["label"]): r["n"] for r in held.groupBy("split", "label").agg(F.sum("n").alias("n")).collect()}  # a row for each split and label
    free = counts if kept is None else counts.join(fixed.select("grp"), "grp", "left_anti")
    chosen: list[tuple] = []
    for split in ("test", "validation"):
        lack = {label: max(0, minimum - has.get((split, label), 0)) for label in labels}
        while any(v > 0 for v in lack.values()):
            open_ = spark.createDataFrame([(k, v) for k, v in lack.items() if v > 0], "label string, lack long")
            rest = free.join(spark.createDataFrame(chosen, f"grp {kind}, split string").select("grp"), "grp", "left_anti")
            gains = rest.join(hinted(open_), "label").groupBy("grp").agg(F.sum(F.least("n", "lack")).alias("gain"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("of"))
            best = gains.filter("gain > 0").withColumn("h", group_order(seed, F.col("grp").cast("string"))).orderBy(F.desc("gain"), "h", "grp").limit(frontier).collect()
            if not best:
                break
            bound = (-best[-1]["gain"], best[-1]["h"]) if len(best) == frontier else None
            left = {r["grp"]: (r["h"], r["of"]) for r in best}
            while left:
                ranked = min((-sum(min(lack[k], n) for k, n in of.items() if lack.get(k, 0) > 0), h, g) for g, (h, of) in left.items())
                if ranked[0] == 0 or (bound and ranked[:2] > bound):
                    break
                _, of = left.pop(ranked[2])
                chosen.append((ranked[2], split))
                for k, n in of.items():
                    lack[k] = max(0, lack[k] - n)
            if not bound and all(not any(lack.get(k, 0) > 0 for k in of) for _, of in left.values()):
                break
    decided = spark.createDataFrame(chosen, f"grp {kind}, split string").unionByName(fixed)
    return counts.select("grp").distinct().join(decided, "grp", "left").select("grp", "split")


def hash_sample(docs: DataFrame, targets: DataFrame, seed: int, key: str = "language") -> DataFrame:
    """The first documents of each language in a seeded hash order, as many as its target; stands in for a reservoir.

    A language may hold most documents: they are ranked in shares first.
    """
    order = F.sha1(F.concat(F.lit(f"{seed}\t"), F.col("doc_id").cast("string")))
    most = targets.agg(F.max("target")).first()[0] or 0
    ranked = docs.withColumn("h", order).withColumn("deal", F.substring("h", 39, 2))
    for keys in ([key, "deal"], [key]):
        ranked = ranked.withColumn("k", F.row_number().over(W.partitionBy(*keys).orderBy("h", "doc_id"))).filter(F.col("k") <= most)
    return ranked.join(hinted(targets), key).filter("k <= target").drop("k", "h", "deal", "target")


def train_cut(sample: DataFrame, seed: int, validation: float = 0.05, key: str = "doc_id") -> DataFrame:
    """Adds ``split``: of the rows in a seeded hash order the first ``int(n * (1 - validation))`` train, the others validate.

    Rows are numbered over all partitions at once, so no task sees all of them.
    """
    order = F.sha1(F.concat(F.lit(f"{seed}\tcut\t"), F.col(key).cast("string")))
    rows = numbered(sample.withColumn("_h", order), "_h", key, name="_place")
    n = rows.count()
    return rows.withColumn("split", F.when(F.col("_place") < int(n * (1 - validation)), "train").otherwise("validation")).drop("_h", "_place")


def water_fill(available: dict[str, int], total: int) -> dict[str, int]:
    """Balanced targets by language: equal shares, what one can't use goes to the others, never over ``total``."""
    out, left, open_ = dict.fromkeys(available, 0), total, sorted(k for k, v in available.items() if v > 0)
    while left > 0 and open_:
        share, extra = divmod(left, len(open_))
        for i, k in enumerate(open_):
            give = min(available[k] - out[k], share + (i < extra))
            out[k] += give
            left -= give
        open_ = [k for k in open_ if out[k] < available[k]]
    return out


def pending(rows: DataFrame) -> DataFrame:
    """Candidates that wait for review: distinct (id, label, language) that aren't rejected or removed."""
    waiting = rows.filter("coalesce(status, '') not in ('rejected', 'removed')")
    return waiting.groupBy("label", "language").agg(F.count_distinct("id").alias("n"))


def unseen(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates whose (issue, label) was not sampled and whose issue isn't closed as a whole (label null)."""
    pairs = registry.filter("label is not null").select("issue", "label").distinct()
    closed = registry.filter("label is null").select("issue").distinct()
    return rows.join(pairs, ["issue", "label"], "left_anti").join(closed, "issue", "left_anti")
