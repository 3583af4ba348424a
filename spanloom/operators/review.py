"""What a review of corpus and candidates needs: searches, repairs, states and export ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import base_document_id, base_label, issue_id, row_text, spaced_json, squeezed

from .bio import spans, tags
from .evaluate import expansion_pattern
from .spans import SPAN, overlapping, to_tokens
from .tokens import tokenise


def tag_search(tagged: DataFrame, wanted: str, tag: str = "tag") -> DataFrame:
    """Hits of a tag: a bare label finds its runs, ``B-``, ``I-`` and ``O`` single tokens. doc_id, token_start, token_stop."""
    if wanted == "O" or wanted[:2] in ("B-", "I-"):
        return tagged.filter(F.col(tag) == wanted).select("doc_id", F.col("i").alias("token_start"), (F.col("i") + 1).alias("token_stop"))
    return spans(tagged, tag, merge_adjacent=True).filter(F.col("label") == wanted).select("doc_id", "token_start", "token_stop")


def unaudited(hits: DataFrame, marks: DataFrame) -> DataFrame:
    """Hits that no verified mark (doc_id, token_start, token_stop) overlaps."""
    return overlapping(hits, marks, "left_anti")


def verified_span(hits: DataFrame, entities: DataFrame, tagged: DataFrame, tag: str = "tag") -> DataFrame:
    """Each hit with the entity that it meets, else the tag run, else O: adds label, span_start, span_stop, found_in."""
    return verified_among(hits, entities, spans(tagged, tag))


def verified_among(hits: DataFrame, entities: DataFrame, runs: DataFrame) -> DataFrame:
    """The same for tag runs that are spans already."""
    key = ["doc_id", "token_start", "token_stop"]

    def first(found: DataFrame, name: str) -> DataFrame:
        met = overlapping(hits.select(*key).distinct(), found.select(*SPAN))
        return met.groupBy("a.doc_id", "a.token_start", "a.token_stop").agg(F.min(F.struct("b.token_start", "b.token_stop", "b.label")).alias(name))

    rows = hits.join(first(entities, "e"), key, "left").join(first(runs, "t"), key, "left")
    best = F.coalesce("e", "t")
    where = F.when(F.col("e").isNotNull(), "entity").when(F.col("t").isNotNull(), "tags").otherwise("none")
    return rows.select(*hits.columns, F.coalesce(best["label"], F.lit("O")).alias("label"), F.coalesce(best["token_start"], F.col("token_start")).alias("span_start"), F.coalesce(best["token_stop"], F.col("token_stop")).alias("span_stop"), where.alias("found_in"))


def retokenised(docs: DataFrame, stored: DataFrame, tag: str = "tag") -> tuple[DataFrame, DataFrame]:
    """Tags of stored tokens moved to canonical tokens by character offsets: new tagged tokens, and spans that don't fit.

    A press agency's span loses an elided article before its name.
    """
    old = spans(stored, tag)
    text = docs.select("doc_id", "text")
    narrow = F.col("label").startswith("org.ent.pressagency.") & F.substr("text", (F.col("start") + 1).cast("int"), F.lit(60)).rlike("^[lL]['’](?=[aA]gence\\b)")
    moved = old.join(text, "doc_id").withColumn("start", F.when(narrow, F.col("start") + 2).otherwise(F.col("start"))).select("doc_id", "label", "start", "stop")
    fresh = tokenise(docs)
    placed = to_tokens(moved, fresh)
    return tags(fresh, placed.filter("aligned").select(*SPAN)), placed.filter("not aligned").select("doc_id", "label", "start", "stop")


def actionable(patches: DataFrame, tagged: DataFrame, entities: DataFrame, tag: str = "tag", lacking: str | None = None) -> DataFrame:
    """Patches that would change something: a tag differs from what the patch asks for, or the entity is missing.

    Tokens that ``tagged`` lacks have the tag ``lacking``; without one they are not compared.
    """
    key = ["doc_id", "token_start", "token_stop", "label"]
    inside = patches.select(*key, F.explode(F.sequence("token_start", F.col("token_stop") - 1)).alias("i")).join(tagged.select("doc_id", "i", F.col(tag).alias("now")), ["doc_id", "i"], "left" if lacking else "inner")
    asked = F.when(F.col("label") == "O", "O").otherwise(F.concat(F.when(F.col("i") == F.col("token_start"), F.lit("B-")).otherwise(F.lit("I-")), F.col("label")))
    now = F.coalesce("now", F.lit(lacking)) if lacking else F.col("now")
    differs = inside.groupBy(*key).agg(F.max((now != asked).cast("int")).alias("differs"))
    known = entities.select(*key).distinct().withColumn("known", F.lit(True))
    rows = patches.join(differs, key, "left").join(known, key, "left")
    return rows.filter((F.col("differs") == 1) | ((F.col("label") != "O") & F.col("known").isNull())).drop("differs", "known")


def review_order(queues: DataFrame) -> list[Column]:
    """Order of labels to review: most missing, least covered, most pending, id."""
    return [F.desc("missing"), F.asc("total"), F.desc("pending"), F.asc("label")]


def state_snapshot(candidates: DataFrame, decided: DataFrame, in_splits: DataFrame, released: DataFrame) -> DataFrame:
    """One row of counts: candidates, with spans, terminal, pending, accepted, in_splits, promoted (in splits and released)."""
    rows = candidates.join(decided.select("id", F.col("status").alias("decided")), "id", "left").join(in_splits.select("id").distinct().withColumn("s", F.lit(1)), "id", "left").join(released.select("id").distinct().withColumn("r", F.lit(1)), "id", "left")
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    done = F.coalesce(F.col("decided").isin("accepted", "rejected", "removed"), F.lit(False))
    return rows.agg(F.count("*").alias("candidates"), n(F.col("n_spans") > 0, "with_spans"), n(done, "terminal"), n(~done, "pending"), n(F.coalesce(F.col("decided") == "accepted", F.lit(False)), "accepted"), n(F.col("s").isNotNull(), "in_splits"), n(F.col("s").isNotNull() & F.col("r").isNotNull(), "promoted"))


def subtoken_summary(subtokens: DataFrame) -> DataFrame:
    """Words by the pattern of their subtokens' tags (doc_id, word, sub, tag), and how often all agree; word -1 is special."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("sub", "tag"))), lambda s: s["tag"])
    return word_summary(subtokens.filter("word >= 0").groupBy("doc_id", "word").agg(ordered.alias("tags")))


def word_summary(words: DataFrame) -> DataFrame:
    """The same for words with their subtokens' ``tags`` in order, which are not sorted and grouped then."""
    agree = F.size(F.array_distinct(F.transform("tags", lambda t: F.coalesce(base_label(t), F.lit("O"))))) == 1
    return words.select(expansion_pattern(F.col("tags")).alias("pattern"), agree.alias("agree")).groupBy("pattern").agg(F.count("*").alias("words"), F.sum(F.col("agree").cast("long")).alias("agreeing"))


def pasted_rows(lines: DataFrame) -> DataFrame:
    """Rows (n, line) of a pasted table: n, token, old, new. Colours, code fences, blanks and headers are dropped; a missing new tag is the old one."""
    plain = squeezed(F.regexp_replace("line", r"\x1b\[[0-9;]*m", ""))
    cells = F.split(plain, r"\s+")
    rows = lines.select("n", plain.alias("p"), cells.alias("c")).filter("p <> '' and not startswith(p, '```') and not startswith(p, '#') and upper(c[0]) <> 'TOKEN' and size(c) >= 2")
    return rows.select("n", F.get("c", F.lit(0)).alias("token"), F.get("c", F.lit(1)).alias("old"), F.coalesce(F.get("c", F.lit(2)), F.get("c", F.lit(1))).alias("new"))


def unannotated(docs: DataFrame, label_ids: DataFrame) -> DataFrame:
    """Documents without entities, with label ids for their labels; an unknown label has none."""
    ids = label_ids.agg(F.map_from_entries(F.collect_list(F.struct("tag", "id"))).alias("ids"))
    return docs.filter(F.size("entities") == 0).crossJoin(F.broadcast(ids)).withColumn("label_ids", F.transform("labels", lambda x: F.try_element_at(F.col("ids"), x))).drop("ids")


def candidates_of(hits: DataFrame) -> DataFrame:
    """Search hits (uid, title, matches, text, snippet) as one candidate for each match: id, document, issue, match, surface_text, offset in the text.

    A hit without matches is one candidate of its whole text.
    """
    each = hits.select("*", F.posexplode_outer("matches").alias("k", "match"))
    text = row_text(F.col("text"), F.array(F.col("match")), F.lit(""), F.col("snippet"))
    clean = squeezed(F.regexp_replace("match", "<[^>]+>", ""))
    suffix = F.when(F.col("k").isNotNull(), F.concat(F.lit("#match-"), (F.col("k") + 1).cast("string"))).otherwise(F.lit(""))
    return each.select(F.concat("uid", suffix).alias("id"), base_document_id(F.col("uid")).alias("document"), issue_id(F.col("uid")).alias("issue"), clean.alias("match"), text.alias("surface_text"), (F.expr("locate(lower(regexp_replace(match, '<[^>]+>', '')), lower(text))") - 1).alias("at"))


def export_ids(rows: DataFrame, content: list[str]) -> DataFrame:
    """Unique ids for export: an id that repeats is followed by ten digits of its content's hash."""
    many = F.count("*").over(W.partitionBy("id")) > 1
    digest = F.substring(F.sha1(spaced_json(*content)), 1, 10)
    return rows.withColumn("id", F.when(many, F.concat("id", F.lit("#snippet-"), digest)).otherwise(F.col("id")))


def registered(registry: DataFrame, drawn: DataFrame) -> DataFrame:
    """The pairs (issue, label) of ``drawn`` that the registry doesn't have yet: what to append to it."""
    return drawn.select("issue", "label").distinct().join(registry.select("issue", "label").distinct(), ["issue", "label"], "left_anti")
