"""The training-data queries: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .byte_pairs import encode_documents
from .decontam import contamination
from .html_text import extract
from .langid import identify
from .media import payload_digests, payload_images
from .packing import pack_documents
from .pii import replace_private
from .prefix_trie import conversation_trie
from .quality import score_quality
from .set_join import jaccard_classes
from .storage import stored
from .token_shards import read_segments, token_sequences, write_shards
from .warc import read_archives, write_archives
from .whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surrogate_key(spark: SparkSession) -> str:
    """The key of surrogates, from the session; the test data has one that is no secret."""
    return spark.conf.get("spark.spanloom.surrogateKey", "test data")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), carry={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark))


def op3_training_order_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_segments(*write_shards(token_sequences(table(spark, sf_dir, "documents"))))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_digests(stored(payload_images(table(spark, sf_dir, "documents")), "media", "zstd"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), least_bytes=0)
    responses = read_archives(spark, manifest).filter("record_type = 'response'")  # payloads are read and held against their digests
    rows = responses.unionByName(read_archives(spark, manifest, payload=False).filter("record_type = 'revisit'"))
    number = lambda c: F.regexp_extract(c, "([0-9]+)$", 1).try_cast("long")
    return rows.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=2).drop("row_id", "text_hash")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op4_jaccard_join": oracles.OP4, "op6_html_extraction": oracles.OP6, "op9_warc": oracles.OP9, "op10_benchmark_decontamination": oracles.OP10, "op12_conversation_trie": oracles.OP12}
