"""Findings of the third round that its first session left open."""

import random

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spanloom.functions import text as t
from spanloom.operators import neighbours
from spanloom.plans import corpus_queries, review_queries
from spanloom.sources import files


def test_nearest_vectors_equal_all_pairs(spark, tmp_path, monkeypatch):
    r = random.Random(3)
    some = [[float(r.randrange(-3, 4)) for _ in range(4)] for _ in range(60)]  # many ties
    odd = [None, [0.0] * 4, [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 1.0], [1.0, 2.0], [], [1.0, float("inf"), 0.0, 1.0]]
    data = list(enumerate(some + odd + some[:9])) + [(7, [1.0, 1.0, 0.0, 0.0]), (None, some[0])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3)
    asked = vectors.filter("vec_id % 7 = 0 or vec_id >= 60 and vec_id < 67").select(F.col("vec_id").alias("q"), F.col("embedding").alias("e"))
    pairs = vectors.join(asked, F.col("vec_id") != F.col("q")).select("q", "vec_id", F.round(t.cosine(F.col("e"), F.col("embedding")), 6).alias("sim"))
    plain = pairs.withColumn("k", F.row_number().over(W.partitionBy("q").orderBy(F.desc("sim"), "vec_id"))).filter("k <= 5").drop("k")
    for name, value in {"ASKED": 9, "TALL": 3, "WIDE": 11}.items():
        monkeypatch.setattr(neighbours, name, value)
    seen = lambda df: sorted(str(tuple(x)) for x in df.collect())
    assert seen(neighbours.nearest_vectors(vectors, asked, 5)) == seen(plain)
    vectors.filter("vec_id is not null").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert "NestedLoop" not in corpus_queries.QUERIES["cosine_topk"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_token_files_are_read_in_their_order(spark, tmp_path):
    """Files of several splits: what a line belongs to is told by the lines before it."""
    line = lambda token: "\t".join([token, *["_"] * 12])
    block = lambda d: [f"# document_id = {d}", "# global.columns = x", "# language = de", "\t".join(files.TOKEN_COLUMNS), *[line(f"w{d}-{k}") for k in range(300)], ""]
    for name, docs in (("a-train.tsv", range(6)), ("b-dev.tsv", range(6, 9))):
        (tmp_path / name).write_text("\n".join(x for d in docs for x in [*block(d)[1:4], block(d)[0], *block(d)[4:]]), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = files.read_token_files(spark, str(tmp_path))
        got = read.select(F.col("comments")["document_id"].cast("int"), "i", "token", "split").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, got)) == [(d, k, f"w{d}-{k}", "train" if d < 6 else "validation") for d in range(9) for k in range(300)]
    leaf = read._jdf.queryExecution().analyzed().collectLeaves().apply(0)
    assert leaf.relation().options().apply("wholetext") == "true"  # a row for each file, not for each line without its place


def test_tag_changes_come_from_one_pass(spark):
    plan = review_queries.QUERIES["tag_changes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
