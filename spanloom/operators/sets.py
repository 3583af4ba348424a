"""Upserts, moves, duplicate reports and comparisons of row sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import candidate_id, casefold
from spanloom.sources.scratch import work_folder

from .tokens import hinted


def upsert(base: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Base rows with incoming ones in place of those of the same key; ``change`` says kept, replaced or added."""
    mine = base.select(key).withColumn("known", F.lit(True)).distinct()
    fresh = incoming.join(mine, key, "left").withColumn("change", F.when(F.col("known"), "replaced").otherwise("added")).drop("known")
    kept = base.join(incoming.select(key).distinct(), key, "left_anti").withColumn("change", F.lit("kept"))
    return kept.unionByName(fresh)


def moved_out(rows: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't targeted to another split than their own."""
    return rows.alias("r").join(targets.alias("t"), F.expr(f"r.{key} = t.{key} and r.split <> t.split"), "left_anti")


def cross_split(rows: DataFrame, key: str) -> DataFrame:
    """Keys of more than one split, with the splits in order and the number of rows."""
    found = rows.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set("split")), ",").alias("splits"), F.count_distinct("split").alias("_splits"), F.count("*").alias("n"))
    return found.filter("_splits > 1").select(key, "splits", "n")


def kept_of_duplicates(rows: DataFrame, key: str, target: str) -> DataFrame:
    """One row of each key: of the target split, else one whose own split (``own``) is the file's (``split``), else the last."""
    rank = F.struct((F.col("split") == target).cast("int"), (F.col("own") == F.col("split")).cast("int"), "ord")
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), rank).alias("r")).select(key, "r.*")


def conflicts(rows: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Keys whose rows differ in content; keys of equal rows aren't reported."""
    return rows.groupBy(key).agg(F.count_distinct(F.sha1(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}))).alias("versions"), F.count("*").alias("n")).filter("versions > 1")


def differences(left: DataFrame, right: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Keys on one side only, or with other content: key, difference (only_left, only_right, changed)."""
    digest = lambda df, name: df.groupBy(key).agg(F.max(F.sha1(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}))).alias(name))
    both = digest(left, "a").join(digest(right, "b"), key, "full_outer")
    kind = F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right").when(F.col("a") != F.col("b"), "changed")
    return both.withColumn("difference", kind).filter("difference is not null").select(key, "difference")


def positional_differences(left: DataFrame, right: DataFrame, order: str, content: list[str]) -> DataFrame:
    """Rows that differ at the same place of ``order``, a dense number from 0; places of one side only differ."""
    a = left.select(F.col(order).alias("place"), F.to_json(F.struct(*content)).alias("a"))
    b = right.select(F.col(order).alias("place"), F.to_json(F.struct(*content)).alias("b"))
    return a.join(b, "place", "full_outer").filter("not (a <=> b)").select("place", F.col("a").isNull().alias("right_only"), F.col("b").isNull().alias("left_only"))


def numbered(rows: DataFrame, *order: str, name: str = "index") -> DataFrame:
    """Rows with a dense number from 0 by ``order``, which should tell all rows apart; stored on the way.

    Rows are dealt by range and sorted in their partitions; a partition's counts
    are added up over the partitions before it, so no task sees all rows.
    """
    spark = rows.sparkSession
    path = work_folder(spark, "numbered")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.schema(rows.select("*").schema.add("_at", "long")).parquet(path)
    part = F.shiftright("_at", 33)
    counts = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    before = counts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    placed = kept.withColumn("_part", part).join(hinted(before), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")


def index_differences(left: DataFrame, right: DataFrame, order: list[str], content: list[str], key: str) -> DataFrame:
    """Two tables compared row by row at the same index: index, key (the left row's), status.

    Rows are numbered by ``order``. ``projection_differs`` is a row whose content
    isn't that of the other side at its index; rows past the shorter table's end
    aren't compared, but one more row, with a null index and key and the
    difference of the row counts, left less right, in ``rows``, says
    ``row_count_differs`` if they do.
    """
    digest = lambda df: F.sha1(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}))
    a = numbered(left, *order).select("index", F.col(key).alias("key"), digest(left).alias("a"))
    b = numbered(right, *order).select("index", digest(right).alias("b"))
    differ = a.join(b, "index").filter("a <> b").select("index", F.col("key").alias(key), F.lit("projection_differs").alias("status"), F.lit(0).cast("long").alias("rows"))
    counts = a.agg(F.count(F.lit(1)).alias("n")).join(b.agg(F.count(F.lit(1)).alias("m")), F.lit(True)).filter("n <> m")
    kind = left.schema[key].dataType
    return differ.unionByName(counts.select(F.lit(None).cast("long").alias("index"), F.lit(None).cast(kind).alias(key), F.lit("row_count_differs").alias("status"), (F.col("n") - F.col("m")).alias("rows")))


def with_ids(rows: DataFrame, order: list[str], *columns: str) -> DataFrame:
    """Rows with ``candidate``: the first of the columns that isn't empty, else ``candidate-`` and the row's number by ``order``."""
    return numbered(rows, *order, name="_index").withColumn("candidate", candidate_id(F.col("_index"), *[F.col(c) for c in columns])).drop("_index")


def release_order(key: str) -> list[Column]:
    return [casefold(F.col(key)), F.col(key)]


def public_rows(docs: DataFrame, fields: list[str]) -> DataFrame:
    """Documents with the listed fields and entities in public form: no empty link, OCR fields folded into one where they say something."""

    def entity(e: Column) -> Column:
        link = F.when(e["wikidata_url"] != "", e["wikidata_url"])
        said = (F.coalesce(e["ocr_surface"], F.lit("")) != "") | (F.coalesce(e["ocr_distance"], F.lit(0.0)) > 0)
        ocr = F.when(said, F.struct(e["ocr_surface"].alias("surface"), e["ocr_distance"].alias("max_levenshtein")))
        return F.struct(e["label"].alias("label"), e["token_start"].alias("token_start"), e["token_stop"].alias("token_stop"), e["surface"].alias("surface"), link.alias("wikidata_url"), ocr.alias("ocr_correction"))

    return docs.select(*[f for f in fields if f != "entities"], F.transform("entities", entity).alias("entities"))
