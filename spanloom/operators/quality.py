"""Validation as data: each broken rule is a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bio import spans
from .spans import SPAN
from .tokens import together, tokenise


def document_faults(docs: DataFrame, tokens: DataFrame, entities: DataFrame, empty_tokens: bool = False) -> DataFrame:
    """Faults of documents (doc_id, text), tokens (i, token, start, stop, tag) and entities: doc_id, rule, place."""
    size = 256  # a token meets the blocks of text that it lies in, not the whole text; tokens and blocks of a document meet once
    cut = docs.select("doc_id", F.length("text").alias("length"), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0)).alias("cut"))
    listed = tokens.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("i", "start", "stop", "token"))).alias("at")).join(cut, "doc_id")

    def broken(x: Column, k: Column) -> Column:
        first = F.floor(x["start"] / size)
        blocks = F.slice("cut", (first + 1).cast("int"), (F.floor(x["stop"] / size) - first + 1).cast("int"))
        off = (x["start"] < 0) | (x["stop"] < x["start"])
        piece = F.when(off, F.lit("")).otherwise(F.substr(F.array_join(blocks, ""), (x["start"] - first * size + 1).cast("int"), (x["stop"] - x["start"]).cast("int")))
        rules = [
            F.when(off | (x["stop"] > F.col("length")), "token_bounds"),
            F.when(x["start"] < F.get("at", k - 1)["stop"], "token_order"),
            F.when(piece != x["token"], "token_text"),
        ]
        if empty_tokens:
            rules.append(F.when(x["stop"] == x["start"], "token_empty"))
        return F.transform(F.filter(F.array(*rules), lambda r: r.isNotNull()), lambda r: F.struct(r.alias("rule"), x["i"].cast("string").alias("place")))

    found = listed.select("doc_id", F.explode(F.flatten(F.transform("at", broken))).alias("f")).select("doc_id", "f.*")
    own = lambda df, k: df.select(*SPAN, F.lit(k).alias("side"))
    both = together(own(spans(tokens, "tag"), 0), own(entities, 1)).groupBy(*SPAN).agg(F.count(F.when(F.col("side") == 0, 1)).alias("tags"), F.count(F.when(F.col("side") == 1, 1)).alias("own"))
    times = lambda name, n, when: F.array_repeat(F.lit(name), F.when(when, F.col(n)).otherwise(0).cast("int"))
    bad = F.coalesce((F.col("token_start") < 0) | (F.col("token_stop") <= F.col("token_start")), F.lit(False))
    rules = F.concat(times("entity_without_tags", "own", F.col("tags") == 0), times("tags_without_entity", "tags", F.col("own") == 0), times("entity_bounds", "own", bad))
    return found.unionByName(both.select("doc_id", F.explode(rules).alias("rule"), F.concat_ws(":", "token_start", "token_stop", "label").alias("place")))


def tokenisation_faults(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Documents whose stored tokens aren't those that ``tokenise`` gives."""
    mine, theirs = tokenise(docs).select("doc_id", "i", "token", "start"), tokens.select("doc_id", "i", "token", "start")
    whole = lambda df, n: df.groupBy("doc_id").agg(F.count("*").alias(n), F.sum(F.xxhash64("i", "token", "start").cast("decimal(38,0)")).alias(f"{n}_sum"))
    both = whole(mine, "a").join(whole(theirs, "b"), "doc_id", "full_outer")
    return both.filter("not (a <=> b and a_sum <=> b_sum)").select("doc_id", F.lit("not_canonical").alias("rule"), F.lit("").alias("place"))


def seed_faults(seeds: DataFrame) -> DataFrame:
    """Faults of dictionary entries (canonical_id, label, display_name, trainable, aliases): canonical_id, rule."""
    n = F.count("*").over(W.partitionBy("canonical_id"))
    rules = F.array(
        F.when(F.coalesce("canonical_id", F.lit("")) == "", "id_missing"),
        F.when(F.col("n") > 1, "id_repeated"),
        F.when(F.coalesce("display_name", F.lit("")) == "", "name_missing"),
        F.when(F.col("trainable") & ~F.coalesce("label", F.lit("")).rlike(r"^org\.ent\.[a-z]+\.[^.]+"), "label_malformed"),
        F.when(F.col("trainable") & (F.coalesce(F.size("aliases"), F.lit(0)) == 0), "aliases_missing"),
    )
    return seeds.withColumn("n", n).select("canonical_id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))


def one_profile(docs: DataFrame) -> DataFrame:
    """The number of tokenisation profiles, which must be 1, and how many rows name none."""
    named = F.when(F.col("tokenization") != "", F.col("tokenization"))
    return docs.agg(F.count_distinct(named).alias("profiles"), F.sum(named.isNull().cast("long")).alias("unnamed"))


def evaluation_faults(predictions: DataFrame, source: DataFrame) -> DataFrame:
    """Ids that only one side has or that repeat: doc_id, rule."""
    count = lambda df, n: df.groupBy("doc_id").agg(F.count("*").alias(n))
    both = count(predictions, "p").join(count(source, "s"), "doc_id", "full_outer")
    rules = F.array(F.when(F.col("s").isNull(), "unknown_document"), F.when(F.col("p").isNull(), "not_predicted"), F.when(F.col("p") > 1, "predicted_twice"), F.when(F.col("s") > 1, "repeated_document"))
    return both.select("doc_id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))
