"""Findings of the third round on growth: one pass over the tokens, no second deal of them, less for each token."""

import re

from pyspark.sql import functions as F

from spanloom.functions import text as t
from spanloom.operators import bio, profile, spans
from spanloom.plans import corpus_queries, review_queries, span_queries


def plan(module, name, spark, step="optimizedPlan"):
    return getattr(module.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution(), step)().toString()


def test_subtoken_audit_groups_no_subtokens(spark):
    assert "collect_list" not in plan(review_queries, "subtoken_audit", spark)


def test_merged_sources_reads_texts_once(spark):
    assert plan(review_queries, "merged_sources", spark).count("Relation") == 1


def test_edges_of_spans_meet_tokens_where_they_lie(spark):
    assert not re.search(r"Exchange hashpartitioning\(doc_id#\d+L?, (?!\d)", plan(review_queries, "char_spans_to_tokens", spark, "executedPlan"))
    tokens = spark.createDataFrame([(0, 0, 0, 2), (0, 1, 3, 4), (1, 0, 0, 5)], "doc_id long, i int, start long, stop long")
    found = spark.createDataFrame([(0, 0, 4, "X"), (0, 0, 4, "X"), (0, 1, 4, "Y"), (1, 0, 4, "X"), (None, 0, 5, "X"), (0, None, 4, "Z")], "doc_id long, start int, stop int, label string")
    got = sorted(map(str, map(tuple, spans.to_tokens(found, tokens).select("doc_id", "label", "start", "stop", "token_start", "token_stop", "aligned").collect())))
    want = [(0, "X", 0, 4, 0, 2, True), (0, "X", 0, 4, 0, 2, True), (0, "Y", 1, 4, None, 2, False), (1, "X", 0, 4, 0, None, False), (None, "X", 0, 5, None, None, False), (0, "Z", None, 4, None, 2, False)]
    assert got == sorted(map(str, want))


def test_tag_parity_reads_texts_once(spark):
    assert plan(span_queries, "tag_parity", spark).count("Relation") == 1


def test_forms_are_made_of_distinct_surfaces(spark):
    said = [("de", s, d, d * 10 + k) for d in range(5) for k, s in enumerate(["Ha", "HA", "ha", "b", "B"][d % 2 :])]
    rows = spark.createDataFrame(said, "lang string, surface string, doc_id long, ord long")
    form = F.lower("surface")
    seen = lambda df: sorted(map(str, df.select("lang", "form", "forms", "n", "examples").collect()))
    assert seen(profile.surface_forms(rows, ["lang"], 3, form)) == seen(profile.surface_forms(rows.withColumn("form", form), ["lang"], 3))
    assert "form#" not in (p := plan(corpus_queries, "surface_norm_freq", spark))[p.rindex("Window") :]


def test_pasted_rows_read_texts_once(spark):
    assert plan(review_queries, "pasted_rows", spark).count("Relation") == 1


def test_tokens_meet_their_text_once(spark, tmp_path):
    assert plan(span_queries, "tok_offsets_check", spark).count("Generate") == 1
    text = "a" * 3000 + " b\U0001d54f " + "c1" * 700 + " " + "d" * 1024 + "e" * 1024
    spark.createDataFrame([(1, text, "de", "s"), (2, None, "fr", "s"), (3, " x", "de", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r)[:3] for r in span_queries.QUERIES["tok_offsets_check"](spark, str(tmp_path)).collect()] == [("de", 1 + 1 + 1400 + 1 + 1, 0)]


def test_white_space_before_tokens_is_the_same(spark):
    every = spark.createDataFrame([(chr(c),) for c in range(0x10000) if not 0xD800 <= c < 0xE000], "c string")
    assert {r["c"] for r in every.filter(F.col("c").rlike(f"^{t.SPACE}$")).collect()} == set(t.SPACES)
    assert "regexp_replace" not in plan(span_queries, "gold_spans", spark)


def test_runs_are_numbered_among_labelled_tokens(spark):
    rows = spark.createDataFrame([(0, i, a, b) for i, (a, b) in enumerate([("B-X", "O"), ("O", "I-X"), ("I-X", "O"), ("I-X", "B-Y"), ("B-X", "I-Y"), ("O", "O"), ("I-Y", "I-Y")])], "doc_id long, i int, a string, b string")
    both = sorted(tuple(r) for r in bio.sided_spans(rows, "a", "b").collect())
    assert both == sorted((0, k, *tuple(r)[1:4]) for k, c in enumerate("ab") for r in bio.spans(rows, c).select("doc_id", "label", "token_start", "token_stop").collect())
    top = bio.sided_spans(rows, "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert top.count("Filter") >= 1 and top.index("Filter") > top.index("Window")  # only labelled tokens are numbered
