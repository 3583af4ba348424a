"""Findings of the third round: unions, overlaps by blocks, shares of texts, replay, faults, forms."""

import random

from pyspark.sql import functions as F

from spanloom.operators import decisions, dictionary, quality, spans, tokens
from spanloom.plans import service_queries

KEY = "doc_id long, token_start int, token_stop int, label string"


def drawn(n: int, seed: int) -> list[tuple]:
    r = random.Random(seed)
    return sorted({(r.randrange(2), a := r.randrange(200), a + r.choice([1, 2, 3, 40]), r.choice("XY")) for _ in range(n)})


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "token_start", "token_stop", "label").collect())


def meets(a, b):
    return a[0] == b[0] and a[1] < b[2] and b[1] < a[2]


def test_union_is_dealt_anew(spark):
    one = spark.range(100).select(F.col("id").alias("doc_id")).repartition(4, "doc_id")
    both = tokens.together(one, one)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(doc_id") < plan.index("Union")


def test_overlaps_by_blocks(spark):
    a, b = drawn(120, 1), drawn(60, 2)
    left, right = spark.createDataFrame(a, KEY), spark.createDataFrame(b, KEY)
    pairs = spans.overlapping(left, right).selectExpr("a.doc_id", "a.token_start", "a.token_stop", "a.label", "b.token_start", "b.token_stop", "b.label")
    assert sorted(map(tuple, pairs.collect())) == sorted((*x, *y[1:]) for x in a for y in b if meets(x, y))
    assert rows(spans.overlapping(left, right, "left_anti")) == [x for x in a if not any(meets(x, y) for y in b)]
    assert "block" in pairs._jdf.queryExecution().optimizedPlan().toString()
    held = lambda x: any(x[0] == y[0] and x[3] == y[3] and y[1] <= x[1] and x[2] <= y[2] and y[2] - y[1] > x[2] - x[1] for y in a)
    assert rows(spans.uncontained(left)) == [x for x in a if not held(x)]


def test_patch_targets_without_pairs(spark):
    a, b = drawn(80, 3), drawn(80, 3)[::2] + drawn(10, 4)
    b = sorted(set(b))
    found = decisions.patch_targets(spark.createDataFrame(a, KEY), spark.createDataFrame(b, KEY))
    new = [x for x in b if x not in a]
    gone = [(*x[:3], "O") for x in a if x not in b and not any(meets(x, y) for y in new)]
    assert rows(found) == sorted(new + gone)
    assert "NestedLoop" not in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "Join" not in plan


def test_texts_are_dealt_by_their_size(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "ab " * 100) for k in range(40)], "doc_id long, text string")
    monkeypatch.setattr(tokens, "SHARE", 1_000)
    assert tokens.dealt(docs).rdd.getNumPartitions() == 13
    assert tokens.dealt(docs.limit(0)).rdd.getNumPartitions() == 1
    assert tokens.tokenise(docs).count() == 4_000


def test_rebuilt_texts_hold_a_text_once(spark):
    toks = spark.createDataFrame([(0, 0, "a", True, False), (0, 1, "b", False, False), (0, 2, "c", False, True)], "doc_id long, i int, token string, no_space boolean, end_of_line boolean")
    assert [tuple(r) for r in tokens.rebuilt_texts(toks).collect()] == [(0, "ab c", 3, 4)]
    assert [(r.start, r.text) for r in tokens.rebuilt(toks).orderBy("i").collect()] == [(0, "ab c"), (1, "ab c"), (3, "ab c")]


def test_faults_past_a_block(spark):
    text = "x" * 300 + " " + "y" * 10
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    toks = spark.createDataFrame([(0, 0, "x" * 300, 0, 300, "O"), (0, 1, "y" * 10, 301, 311, "O"), (0, 2, "y", 310, 312, "O"), (0, 3, "z", -1, 0, "O")], "doc_id long, i int, token string, start int, stop int, tag string")
    found = quality.document_faults(docs, toks, spark.createDataFrame([(0, 2, 2, "X")] * 2, KEY))
    assert sorted((r.rule, r.place) for r in found.collect()) == sorted([("token_bounds", "2"), ("token_bounds", "3"), ("token_order", "2"), ("token_order", "3"), ("token_text", "3"), *[("entity_bounds", "2:2:X"), ("entity_without_tags", "2:2:X")] * 2])


def test_replay_finds_spans_by_blocks():
    held = decisions._Held({(0, 2): "X", (60, 130): "Y", (200, 201): "Z"})
    assert held.meeting(1, 61) == {(0, 2), (60, 130)} and held.meeting(128, 129) == {(60, 130)} and not held.meeting(130, 200)
    held.drop((60, 130))
    assert not held.meeting(2, 200) and (60, 130) not in held.spans


def test_context_comes_with_all_hits(spark):
    toks = tokens.tokenise(spark.createDataFrame([(0, "(Havas) x y z w Havas said")], "doc_id long, text string"))
    hits = dictionary.match(toks, dictionary.seeds_from(spark, [("L", "Havas", 0)]))
    found = dictionary.with_context(toks, hits).orderBy("token_start").collect()
    assert [(r.token_start, r.dispatch, r.reporting) for r in found] == [(1, True, False), (7, False, True)]


def test_sql_folds_sharp_s():
    import duckdb

    form = service_queries._FORM
    assert duckdb.execute(f"select {form.format("'ß'")}").fetchall() == [("ss",)]
