"""The corpus pipeline: language, near duplicates, benchmark leaks, private data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns that they were given. ``run`` applies
them to ``documents``. No SQL states the whole: classifiers and tokenizers have
none, so tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.decontam import contamination
from spanloom.llm.langid import UNDETERMINED, fit, predict
from spanloom.llm.packing import pack_documents
from spanloom.llm.pii import replace_private
from spanloom.llm.queries import surrogate_key
from spanloom.llm.set_join import jaccard_classes
from spanloom.llm.storage import finished, stored

#: Word shingles and similarity of near duplicates.
WIDTH, PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language stays ambiguous. Fitted on the documents' own labels.

    Null texts go; without any label no language is known, and all go.
    """
    own = {c: f"_{c}" if c in ("lang_pred", "score", "ambiguous") else c for c in docs.columns}  # columns that predictions would replace
    judged = predict(docs.withColumnsRenamed(own), fit(docs.select("doc_id", "text", "lang")))
    return judged.filter((F.col("lang_pred") != UNDETERMINED) & ~F.col("ambiguous")).select(*[F.col(new).alias(c) for c, new in own.items()])


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near duplicates, and one of rows that repeat as a whole.

    Rows of null doc_id belong to no class and stay.
    """
    first = finished(spark, "first", lambda: jaccard_classes(docs, WIDTH, PERCENT).filter("doc_id = component_id").select("doc_id").distinct())
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark phrase; rows of a repeated or null doc_id are told apart by their text.

    Null and empty texts hold none and stay, and an empty benchmark drops nothing.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = finished(spark, "contaminated", lambda: contamination(docs, items).filter("contaminated").select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct())
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.xxhash64("text") == F.col("hit_hash")), "left_anti")


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates; all rows stay, null and empty texts and repeated rows as they are."""
    return replace_private(docs, surrogate_key(spark)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences; null texts are empty ones, repeated rows are packed one by one."""
    return pack_documents(docs, carry={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_class),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_private_data),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored for the next. An empty table gives no rows, further columns go along."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
