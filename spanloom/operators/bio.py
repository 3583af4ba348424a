"""BIO tags and spans: one decoder, one encoder, checks of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import base_label, family

from .tokens import by_document, hinted, islands


def spans(tagged: DataFrame, tag: str = "tag", merge_adjacent: bool = False, on_malformed: str = "begin") -> DataFrame:
    """Spans of a tagged token table: doc_id, label, token_start, token_stop, and start, stop where tokens have them.

    An I that doesn't go on the span before begins one (``begin``), is left out
    (``outside``) or stops the job (``error``). With ``merge_adjacent`` a B that
    touches a span of its label goes on with it. A span breaks where tokens are
    missing in between.
    """
    label, before = base_label(F.col(tag)), base_label(F.lag(tag).over(by_document()))
    rows = tagged.withColumn("label", label).withColumn("before", F.when(F.lag("i").over(by_document()) == F.col("i") - 1, before))
    goes_on = F.col("label").eqNullSafe(F.col("before"))
    orphan = F.col(tag).startswith("I-") & ~goes_on
    if on_malformed == "error":
        rows = rows.withColumn("label", F.when(orphan, F.raise_error(F.concat(F.lit("malformed tag in "), F.col("doc_id").cast("string")))).otherwise(F.col("label")))
    begins = ~goes_on if merge_adjacent else (~goes_on | F.col(tag).startswith("B-"))
    rows = islands(rows.withColumns({"orphan": orphan, "begins": begins}).filter("label is not null"), F.col("begins"))  # what has no label parts no run that a label doesn't begin
    sums = [F.min("i").alias("token_start"), (F.max("i") + 1).alias("token_stop")]
    sums += [F.min("start").alias("start"), F.max("stop").alias("stop")] if {"start", "stop"} <= set(tagged.columns) else []
    out = rows.groupBy("doc_id", "island").agg(F.first("label").alias("label"), F.min_by("orphan", "i").alias("orphan"), *sums)
    return (out.filter("not orphan") if on_malformed == "outside" else out).drop("island", "orphan")


def sided_spans(tagged: DataFrame, *tags: str) -> DataFrame:
    """Spans of several tag columns in one pass over the tokens: doc_id, side (the column's place), label, token_start, token_stop.

    A malformed I begins a span; a span breaks where tokens are missing in between.
    """
    rows = tagged.select("doc_id", "i", *tags)
    near = F.lag("i").over(by_document()) == F.col("i") - 1
    for k, tag in enumerate(tags):
        label = base_label(F.col(tag))
        goes_on = label.eqNullSafe(F.when(near, base_label(F.lag(tag).over(by_document())))) & ~F.col(tag).startswith("B-")
        rows = rows.withColumns({f"l{k}": label, f"b{k}": (~goes_on).cast("int")})
    rows = rows.filter(" or ".join(f"l{k} is not null" for k in range(len(tags))))  # the first token of a run begins it, whatever is left out before
    up_to = by_document().rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"n{k}": F.sum(f"b{k}").over(up_to) for k in range(len(tags))})
    each = F.filter(F.array(*[F.struct(F.lit(k).alias("side"), F.col(f"l{k}").alias("label"), F.col(f"n{k}").alias("island")) for k in range(len(tags))]), lambda s: s["label"].isNotNull())
    found = rows.select("doc_id", "i", F.explode(each).alias("s")).select("doc_id", "i", "s.*")
    return found.groupBy("doc_id", "side", "island").agg(F.first("label").alias("label"), F.min("i").alias("token_start"), (F.max("i") + 1).alias("token_stop")).drop("island")


def scored_spans(tagged: DataFrame, tag: str = "tag") -> DataFrame:
    """Spans with the least confidence and margin of their tokens."""
    found = spans(tagged, tag)
    inside = tagged.select("doc_id", "i", "confidence", "margin").join(found, "doc_id").filter("i >= token_start and i < token_stop")
    return inside.groupBy("doc_id", "label", "token_start", "token_stop").agg(F.min("confidence").alias("confidence"), F.min("margin").alias("margin"))


def tags(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """The token table with ``tag`` from spans (doc_id, label, token_start, token_stop); spans that overlap stop the job."""
    cover = found.select("doc_id", "label", "token_start", F.explode(F.sequence("token_start", F.col("token_stop") - 1)).alias("i"))
    one = cover.groupBy("doc_id", "i").agg(F.count("*").alias("n"), F.first("label").alias("label"), F.first("token_start").alias("token_start"))
    one = one.withColumn("label", F.when(F.col("n") > 1, F.raise_error(F.lit("overlapping spans"))).otherwise(F.col("label")))
    tag = F.when(F.col("label").isNull(), F.lit("O")).otherwise(F.concat(F.when(F.col("i") == F.col("token_start"), F.lit("B-")).otherwise(F.lit("I-")), F.col("label")))
    return tokens.join(one.drop("n"), ["doc_id", "i"], "left").withColumn("tag", tag).drop("label", "token_start")


def violations(tagged: DataFrame, tag: str = "tag") -> DataFrame:
    """I tags that nothing begins, with the kind of what stands before: doc_id, i, tag, before, violation."""
    rows = tagged.withColumn("before", F.lag(tag).over(by_document())).filter(F.col(tag).startswith("I-"))
    before, mine = F.col("before"), F.substr(tag, F.lit(3))
    kind = (
        F.when(before.isNull(), F.lit("sequence_start_to_I"))
        .when(before == "O", F.lit("O_to_I"))
        .when(~before.rlike("^[BI]-."), F.lit("malformed_previous_to_I"))
        .when(F.substr("before", F.lit(3)) != mine, F.lit("different_label_to_I"))
    )
    return rows.withColumn("violation", kind).filter("violation is not null").select("doc_id", "i", F.col(tag).alias("tag"), "before", "violation")


def label_map(tagged: DataFrame, *columns: str, both: bool = False) -> DataFrame:
    """Ids of tags: O is 0, then labels in order, B before I. ``both``: each label has B and I, seen or not."""
    seen = tagged.select(F.explode(F.array(*columns)).alias("tag")).filter("tag is not null and tag <> 'O'").distinct()
    if both:
        seen = seen.select(base_label(F.col("tag")).alias("base")).distinct().select(F.explode(F.array(F.concat(F.lit("B-"), "base"), F.concat(F.lit("I-"), "base"))).alias("tag"))
    ranked = seen.select("tag", F.expr("row_number() over (order by substring(tag, 3), substring(tag, 1, 1))").cast("long").alias("id"))
    return ranked.unionByName(tagged.sparkSession.createDataFrame([("O", 0)], "tag string, id long"))


def check_label_map(labels: DataFrame) -> DataFrame:
    """Faults of a label map (tag, id): ids not contiguous from 0, repeated tags or ids, not one O, B or I without the other."""
    n = labels.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("tag").alias("tags"), F.min("id").alias("low"), F.max("id").alias("high"), F.sum((F.col("tag") == "O").cast("int")).alias("o"))
    whole = n.select(F.explode(F.filter(F.array(F.when(F.col("ids") != F.col("n"), F.lit("repeated_id")), F.when(F.col("tags") != F.col("n"), F.lit("repeated_tag")), F.when((F.col("low") != 0) | (F.col("high") != F.col("n") - 1), F.lit("not_contiguous")), F.when(F.col("o") != 1, F.lit("not_one_O"))), lambda x: x.isNotNull())).alias("fault")).select("fault", F.lit(None).cast("string").alias("label"))
    half = labels.filter("tag <> 'O'").groupBy(base_label(F.col("tag")).alias("label")).agg(F.count_distinct(F.substring("tag", 1, 1)).alias("k")).filter("k < 2").select(F.lit("unpaired").alias("fault"), "label")
    return whole.unionByName(half)


def import_tags(tagged: DataFrame, seeds: DataFrame, repair: bool = True) -> DataFrame:
    """Imported tags by policy: the token table with ``tag`` made public, ``reason`` of excluded tokens and ``repaired``.

    ``seeds``: id (as in the raw tags, any case), label, trainable. A raw label
    without a trainable seed is excluded; an I without its span is made a B, or
    stops the job.
    """
    # Raw labels that are never imported.
    reasons = {"unk": "unknown_agency", "ag": "generic_agency_marker", "pers.ind.articleauthor": "article_author"}
    base = F.lower(base_label(F.col("tag")))
    rows = tagged.withColumn("raw", base).join(hinted(seeds.select(F.lower("id").alias("raw"), F.col("label").alias("public"), "trainable")), "raw", "left")
    ok = F.col("public").isNotNull() & F.coalesce("trainable", F.lit(False))
    reason = F.lit("unknown_label")
    for name, why in reasons.items():
        reason = F.when(F.col("raw") == name, F.lit(why)).otherwise(F.when(F.col("trainable") == False, F.lit("non_trainable_label")).otherwise(reason) if name == "unk" else reason)  # noqa: E712
    rows = rows.withColumn("ok", ok).withColumn("reason", F.when(F.col("raw").isNotNull() & ~ok, reason))
    follows = F.coalesce((F.lag("raw").over(by_document()) == F.col("raw")) & F.lag("ok").over(by_document()), F.lit(False))
    orphan = F.col("ok") & F.col("tag").startswith("I-") & ~follows
    begin = F.col("tag").startswith("B-") | ~follows
    if not repair:
        begin = F.when(orphan, F.raise_error(F.lit("I tag without its span")).cast("boolean")).otherwise(begin)
    public = F.when(~F.col("ok") | F.col("raw").isNull(), F.lit("O")).otherwise(F.concat(F.when(begin, F.lit("B-")).otherwise(F.lit("I-")), F.col("public")))
    return rows.withColumn("repaired", F.coalesce(orphan, F.lit(False))).withColumn("tag", public).drop("public", "trainable", "ok")


def with_family(found: DataFrame) -> DataFrame:
    return found.withColumn("family", family(F.col("label")))
