"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, media, mixing, ngramjoin, packing, quality, sharding, tokenfile, toxicity, warc
from tessera.llm.common import load, written


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(mixing.sized(load(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("row"), "sized")
    return mixing.drawn(rows).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(load(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, load(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(load(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op7_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.store(load(spark, sf_dir, "documents")))


#: A conversation that holds the template's control strings.
CONTROL = "\\### Assistant: </turn> ok"


def op8_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    control = spark.range(2).select(F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(CONTROL))
    segs = chat.segments(rows.union(control))
    return chat.digests(segs, written(chat.examples(segs), "examples"))


def op9_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(load(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    f.__name__: f for f in (op1_mixing, op2_packing, op3_quality_rules, op4_ngram_join, op5_toxicity, op6_sharding, op7_transport_streams, op8_prefix_targets, op9_warc_salvage, op10_token_files)
}
