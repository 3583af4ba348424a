"""Findings of the fourth round."""

import pathlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.functions import tables
from spanloom.llm import media
from spanloom.llm import queries as llm_queries
from spanloom.operators import decisions, review
from spanloom.plans import base, review_queries, service_queries
from spanloom.sources import files

SMALL = "/root/testdata/sf0.001"


def plan(df, step="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), step)().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_tensors_are_in_the_result(spark, monkeypatch):
    monkeypatch.setattr(media, "PART", 1000)  # several parts of a batch
    found = llm_queries.op5_progressive_jpeg(spark, SMALL).limit(20).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(found) == 20
    for r in found:
        raw = texts[r["doc_id"]]
        image = media.Image(media.payload_image(raw + b" " * (-len(raw) % 192 or (0 if raw else 192))))
        assert (r["height"], r["width"]) == (image.frame.height, image.frame.width)
        assert np.array_equal(np.frombuffer(r["rgb"], np.uint8).reshape(r["height"], r["width"], 3), image.rgb()) and r["feature"] == media.describe(image.rgb())


def test_labelled_tokens_are_those_of_the_whole_table(spark, tmp_path):
    texts = ["The the The THE that", "la", "", None, "x  ", "Los los. Than the", "Sich sich Sich sich sich sich", "one two three"] + ["The le Pour of Eriner the " * 30 + "la"] * 20
    docs = spark.createDataFrame([(k, x, "de", "s") for k, x in enumerate(texts)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for at in (str(tmp_path), SMALL):
        whole = base.tagged(spark, at).select("doc_id", "i", "gold", "predicted")
        told = (F.col("gold") != "O") | (F.col("predicted") != "O")
        assert rows(base.labelled(spark, at)) == rows(whole.filter(told))
        last = whole.groupBy("doc_id").agg(F.max("i").alias("n"))
        assert rows(base.labelled(spark, at, last=True)) == rows(whole.join(last, "doc_id").filter(told | (F.col("i") == F.col("n"))).drop("n"))
    assert plan(base.labelled(spark, SMALL)).count("regexp_extract_all") == 1  # texts are cut once, not for an inferred filter as well


def test_choices_are_replayed_in_one_pass_without_groups_of_pandas(spark):
    found = plan(review_queries.QUERIES["curation_choices"](spark, SMALL))
    assert "CoGroup" not in found and found.count("Relation") == 1


def test_choices_of_many_documents(spark):
    held = [(0, 0, 2, "x"), (0, 4, 6, "x"), (0, 9, 10, None), (1, 0, 3, "y"), (None, 1, 2, "z")]
    span = "array<struct<token_start:int,token_stop:int,label:string>>"
    log = [
        (0, 2, "gold", None, [(1, 5, "b")], []),  # replaced by what comes next in order
        (0, 1, "both", None, [(0, 2, "x")], [(3, 5, "a")]),
        (1, 1, "neither", None, [(0, 3, "y")], []),
        (2, 1, "manual", "m", [], [(7, 8, "p"), (8, 9, "q")]),
        (2, None, "skip", None, [], [(7, 8, "p")]),
        (None, 1, "prediction", "w", [(1, 2, "z")], [(2, 3, "z")]),
    ]
    docs = spark.createDataFrame(held, "doc_id long, token_start int, token_stop int, label string")
    choices = spark.createDataFrame(log, f"doc_id long, ord int, choice string, correct_label string, gold {span}, predicted {span}")
    got = sorted(map(tuple, decisions.apply_choices(docs, choices).collect()), key=str)
    assert got == sorted([(0, 1, 5, "b"), (0, 9, 10, None), (2, 7, 8, "m"), (None, 2, 3, "w")], key=str)


def test_verified_spans_cut_texts_once(spark):
    assert "regexp_extract_all" not in plan(review_queries.QUERIES["verified_spans"](spark, SMALL))  # only when the tokens are stored


def test_patches_are_replayed_on_stored_spans(spark):
    found = plan(review_queries.QUERIES["span_patches"](spark, SMALL))
    assert "CoGroup" not in found and "regexp_extract_all" not in found  # texts are cut once, when the spans are stored


def test_patches_of_many_documents(spark):
    held = [(0, 0, 2, "x"), (0, 4, 6, "x"), (1, 0, 1, "y"), (None, 1, 2, "z")]
    log = [
        (0, "b", "2024", "accept", 1, 5, "n"),
        (0, "a", "2024", "modify", 5, 7, "m"),  # comes before b, which doesn't touch it
        (0, "c", None, "accept", 5, 7, "O"),  # without a time it comes last
        (1, "a", "2024", "reject", 0, 1, "O"),
        (2, "a", "2024", "accept", 3, 4, "w"),
        (None, "a", "2024", "accept", 1, 2, "z"),
    ]
    spans = spark.createDataFrame(held, "doc_id long, token_start int, token_stop int, label string")
    patches = spark.createDataFrame(log, "doc_id long, review_id string, reviewed_at string, choice string, token_start int, token_stop int, label string")
    got = sorted(map(tuple, decisions.apply_patches(spans, patches).collect()), key=str)
    assert got == sorted([(0, 1, 5, "n", "replaced"), (1, 0, 1, "y", "kept"), (2, 3, 4, "w", "added"), (None, 1, 2, "z", "kept")], key=str)


def test_actionable_patches_cut_texts_once(spark):
    assert "regexp_extract_all" not in plan(review_queries.QUERIES["actionable_patches"](spark, SMALL))  # only when the tokens are stored


def test_tokens_without_a_tag_count_as_outside(spark):
    rows = spark.createDataFrame([(0, 0, "B-X"), (0, 1, "I-X"), (0, 7, "B-Y")], "doc_id long, i int, tag string")
    span = "doc_id long, token_start int, token_stop int, label string"
    entities = spark.createDataFrame([(0, 0, 2, "X"), (0, 7, 8, "Y")], span)
    patches = spark.createDataFrame([(0, 0, 2, "X"), (0, 4, 6, "O"), (0, 6, 8, "O"), (0, 3, 5, "X"), (0, 7, 9, "Y")], span)
    got = sorted(tuple(r)[1:] for r in review.actionable(patches, rows, entities, lacking="O").collect())
    assert got == [(3, 5, "X"), (6, 8, "O"), (7, 9, "Y")]


def test_tokens_of_texts_are_made_as_columns(spark, tmp_path):
    texts = ["", None, "  ", "a1_b\u0301 \x85c\x1c", "\U0001d54f-x  ", "²½ٍ", "x" * 3000 + " é" * 3000] * 30
    got = tables.token_arrays(pa.array(texts)).to_pylist()
    assert [[(t["token"], t["start"], t["stop"]) for t in x] for x in got] == [list(tables.token_pieces(x or "")) for x in texts]
    assert tables.token_arrays(pa.array([], pa.string())).to_pylist() == []
    docs = [(k, x, "de", "s") for k, x in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = service_queries.QUERIES["lateral_tokens"](spark, str(tmp_path))
    each = [(i, start) for x in texts for i, (_, start, _) in enumerate(tables.token_pieces(x or ""))]
    assert [tuple(r) for r in found.collect()] == [("de", len(each), 0, sum(start * (i % 97) for i, start in each))]
    assert "UDTF" not in (shape := plan(found, "executedPlan")) and "Join" not in shape and "ArrowEvalPython" in shape


def test_token_files_are_compressed_and_read_without_a_shuffle(spark):
    found = review_queries.QUERIES["token_file_round_trip"](spark, SMALL)
    shape = plan(found)
    assert "RepartitionByExpression" not in shape and "Window" not in shape
    written = [pathlib.Path(p.removeprefix("file:").replace("//", "/")) for p in found.inputFiles()]
    assert written and all(p.name.endswith(".txt.gz") for p in written)
    texts = sum(len((r["text"] or "").encode()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert sum(p.stat().st_size for p in written) < texts  # a token's line has some thirty characters
    whole = base.tagged(spark, SMALL).groupBy("doc_id", "lang").agg(F.count("*"), F.sum((F.col("gold") != "O").cast("long")), F.sum(F.length("token") * (F.col("i") % 97)))
    assert rows(found.drop("split").toDF("a", "b", "c", "d", "e")) == rows(whole.toDF("a", "b", "c", "d", "e"))


@pytest.mark.parametrize("share", [files.SHARE, 10])
def test_segments_of_token_files(spark, tmp_path, monkeypatch, share):
    monkeypatch.setattr(files, "SHARE", share)  # a file of many shares is dealt
    line = lambda token: "\t".join([token, *["_"] * 12])
    link = lambda x: f"# segment_iiif_link = {x}"
    text = ["# language = de", link("u"), line("a"), link("u"), line("b"), "# other", link(""), line("c"), "  ", link("u"), line("d"), "# language = fr", line("e"), link("u"), line("#")]
    (tmp_path / "x-test.tsv").write_text("\r\n".join(text), encoding="utf-8")
    got = files.read_token_files(spark, str(tmp_path)).select("doc", "i", "token", "segment", "split", F.col("comments")["language"]).collect()
    assert sorted(map(tuple, got)) == [(0, 0, "a", 1, "test", "de"), (0, 1, "b", 1, "test", "de"), (0, 2, "c", 2, "test", "de"), (0, 3, "d", 3, "test", "de"), (1, 0, "e", 0, "test", "fr"), (1, 1, "#", 1, "test", "fr")]
    (tmp_path / "y-test.tsv").write_text("a\tb", encoding="utf-8")
    with pytest.raises(Exception, match="13 fields"):
        files.read_token_files(spark, str(tmp_path)).collect()


def test_rows_are_exported_once(spark):
    assert "MapInArrow" not in plan(service_queries.QUERIES["exported_rows"](spark, SMALL))  # only when they are stored
    for text in ("", "a  b\n", "x_1 é\t", "\U0001d54f"):
        for more in ("", "\n...\nfrom y", "\n...\n "):
            tokens, starts, stops = tables.token_columns(text)
            added = tables.token_columns(more)
            moved = [(t, a + len(text), b + len(text)) for t, a, b in zip(*added, strict=True)]
            assert [*zip(tokens, starts, stops, strict=True), *moved] == list(tables.token_pieces(text + more))
