"""Review operators on small cases."""

from pyspark.sql import functions as F

from spanloom.operators import review


def tagged(spark, tags):
    return spark.createDataFrame([(0, i, f"t{i}", 3 * i, 3 * i + 2, tag) for i, tag in enumerate(tags)], "doc_id long, i int, token string, start int, stop int, tag string")


def tuples(df):
    return sorted(map(tuple, df.collect()))


def test_searches(spark):
    rows = tagged(spark, ["B-X", "B-X", "O", "I-X", "B-Y"])
    assert tuples(review.tag_search(rows, "X")) == [(0, 0, 2), (0, 3, 4)] and tuples(review.tag_search(rows, "B-X")) == [(0, 0, 1), (0, 1, 2)]
    hits = spark.createDataFrame([(0, 0, 1), (0, 2, 3), (0, 4, 5)], "doc_id long, token_start int, token_stop int")
    ents = spark.createDataFrame([(0, 4, 5, "Z")], "doc_id long, token_start int, token_stop int, label string")
    got = {r["token_start"]: (r["label"], r["span_start"], r["span_stop"], r["found_in"]) for r in review.verified_span(hits, ents, rows).collect()}
    assert got == {0: ("X", 0, 1, "tags"), 2: ("O", 2, 3, "none"), 4: ("Z", 4, 5, "entity")}
    assert review.unaudited(hits, ents).count() == 2


def test_retokenised_and_actionable(spark):
    docs = spark.createDataFrame([(0, "x l'Agence Ha.")], "doc_id long, text string")
    label = "org.ent.pressagency.h"
    old = spark.createDataFrame([(0, 0, "x", 0, 1, "O"), (0, 1, "l'Agence", 2, 10, f"B-{label}"), (0, 2, "Ha.", 11, 14, f"I-{label}")], "doc_id long, i int, token string, start int, stop int, tag string")
    new, bad = review.retokenised(docs, old)
    assert [(r["token"], r["tag"][:2]) for r in new.orderBy("i").collect()] == [("x", "O"), ("l", "O"), ("'", "O"), ("Agence", "B-"), ("Ha", "I-"), (".", "I-")] and bad.count() == 0
    rows = tagged(spark, ["B-X", "O"])
    patches = spark.createDataFrame([(0, 0, 1, "X"), (0, 1, 2, "Y"), (0, 1, 2, "O")], "doc_id long, token_start int, token_stop int, label string")
    assert tuples(review.actionable(patches, rows, patches.limit(1)).select("label")) == [("Y",)]


def test_states_and_exports(spark):
    cand = spark.createDataFrame([("a", 1), ("b", 0), ("c", 2)], "id string, n_spans int")
    dec = spark.createDataFrame([("a", "accepted"), ("c", "skipped")], "id string, status string")
    one = spark.createDataFrame([("a",)], "id string")
    assert tuple(review.state_snapshot(cand, dec, one, one).first()) == (3, 2, 1, 2, 1, 1, 1)
    subs = spark.createDataFrame([(0, -1, 0, "O"), (0, 0, 0, "B-X"), (0, 0, 1, "I-X"), (0, 1, 0, "O"), (0, 1, 1, "B-X"), (0, 2, 0, "O")], "doc_id long, word int, sub int, tag string")
    assert tuples(review.subtoken_summary(subs)) == [("all_O", 1, 1), ("first_O_continuation_entity", 1, 0), ("valid_B", 1, 1)]
    lines = spark.createDataFrame([(0, "```"), (1, "TOKEN OLD NEW"), (2, "\x1b[1mHa\x1b[0m  O  B-X"), (3, ""), (4, "b O")], "n int, line string")
    assert tuples(review.pasted_rows(lines)) == [(2, "Ha", "O", "B-X"), (4, "b", "O", "O")]
    ids = [r["id"] for r in review.export_ids(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, n int"), ["n"]).collect()]
    assert len(set(ids)) == 3 and "b" in ids and all(i == "b" or i.startswith("a#snippet-") for i in ids)
    hits = spark.createDataFrame([("p-1-i3", ["x <em>Ha</em>"], "Say x Ha.", "s"), ("q", None, None, "snip")], "uid string, matches array<string>, text string, snippet string")
    got = {r["id"]: r for r in review.candidates_of(hits).collect()}
    assert got["p-1-i3#match-1"]["at"] == 4 and got["p-1-i3#match-1"]["issue"] == "p-1" and got["q"]["surface_text"] == "snip"
    docs = spark.createDataFrame([(0, [], ["O", "??"]), (1, ["e"], ["O"])], "doc_id long, entities array<string>, labels array<string>")
    assert [list(r["label_ids"]) for r in review.unannotated(docs, spark.createDataFrame([("O", 0)], "tag string, id int")).collect()] == [[0, None]]
    pairs = spark.createDataFrame([("i", "l"), ("j", "l")], "issue string, label string")
    assert tuples(review.registered(pairs.limit(1), pairs.unionByName(pairs))) == [("j", "l")]
    assert review.review_order(cand) and F is not None
