"""The pipeline's stages on planted cases, and its run against the stages by hand."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as C
from spanloom.llm.packing import default_tokenizer, encoder


def planted(spark):
    rng = random.Random(11)
    english = "the of and to with that then from this only they have".split()
    german = "und der nicht schön ist zu ein mit auf sich werden noch".split()
    clean = [(i, " ".join(rng.choice(english if i % 2 else german) + str(rng.randint(0, 40)) * (k % 3 == 0) for k in range(60)), "en" if i % 2 else "de") for i in range(60)]
    rows = list(clean)
    rows += [(100, clean[3][1], "en"), (101, clean[5][1].replace(" ", "  ", 3) + " end", "en")]  # an exact and a near copy
    rows += [(102, "they have " + "alpha bravo charlie delta echo foxtrot golf hotel india juliet " + clean[7][1][:80], "en")]  # a leak
    rows += [(103, "this only they have that then jo@x.example.com from the and of to with that", "en")]
    rows += [(104, None, "en"), (105, "12345 !!", "de"), (106, "", None)]
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long"), {i for i, *_ in clean}


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    docs, clean = planted(spark)
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "alpha bravo charlie delta echo foxtrot golf hotel india juliet")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}
    kept = docs
    seen = []
    for _name, stage in C.STAGES[:-1]:
        kept = C.stored(stage(spark, kept, sf), "stage")
        assert kept.columns == docs.columns
        seen.append(ids(kept))
    assert seen[0] == ids(docs) - {104, 105, 106}
    assert seen[1] == seen[0] - {100, 101} and seen[2] == seen[1] - {102} and seen[3] == seen[2] and clean <= seen[3]
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "jo@x.example.com" not in texts[103] and all(texts[i] == before[i] for i in clean)
    out = C.run(spark, sf).toPandas()
    enc = encoder(*default_tokenizer())
    assert out.groupby("doc_id")["length"].sum().to_dict() == {i: len(enc.encode_ordinary(t)) + 1 for i, t in texts.items()}
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048


def test_stages_keep_repeats_nulls_and_clashing_columns(spark, tmp_path):
    docs, clean = planted(spark)
    docs = docs.withColumn("component_id", F.lit("mine")).withColumn("n_hit", F.lit(-1)).withColumn("lang_pred", F.lit("x")).withColumn("length", F.lit(9))
    some = docs.filter("doc_id in (3, 5)")
    docs = docs.unionByName(some).unionByName(docs.filter("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    spark.createDataFrame([(1, "alpha bravo charlie delta echo foxtrot golf hotel india juliet")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for _name, stage in C.STAGES[:-1]:
        kept = C.stored(stage(spark, kept, str(tmp_path)), "stage")
        assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} >= clean | {None} and sum(r["doc_id"] == 3 for r in rows) == 1
    assert {(r["component_id"], r["n_hit"], r["lang_pred"], r["length"]) for r in rows} == {("mine", -1, "x", 9)}
    assert C.STAGES[-1][1](spark, kept, str(tmp_path)).select("doc_id").distinct().count() == len({r["doc_id"] for r in rows})


def test_stages_work_on_empty_tables(spark, tmp_path):
    docs, _ = planted(spark)
    empty = docs.limit(0)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
