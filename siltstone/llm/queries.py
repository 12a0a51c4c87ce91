"""Registered queries of the operators: each over its whole table.

ORACLE has the SQL of those that SQL can express.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    adaptive_rules,
    alignment,
    anchor_simhash,
    cross_polytope,
    gumbel_pieces,
    hmm,
    hnsw,
    pareto_mix,
    quality_gam,
    spelling,
    splitters,
    style_tree,
    warc,
)
from siltstone.llm.shared import new_path, written

SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_gam.train(docs, _table(spark, sf_dir, "labels"))
    return quality_gam.scored(docs.withColumn("held_out", quality_gam.held_out(F.col("doc_id"))), model).select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted")
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.with_revisits(_table(spark, sf_dir, "pages"))
    files = warc.write_archive(pages, new_path(spark, "warc"))
    records = warc.resolved(warc.whole(written(warc.read_archive(files, payload=False), "records"), files))
    return records.select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to_page").alias("refers_to"), "digest_holds",
    )


def op3_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.hmm_scores(_table(spark, sf_dir, "documents"))


def op4_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return adaptive_rules.adaptive_rules(docs, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pareto_mix.pareto_mix(docs, carry=["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "inclusion"
    )


def op7_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_text(_table(spark, sf_dir, "pages")).select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op8_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    records = _table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(text).cast("long").alias("bytes"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )
    shards = splitters.splitter_shards(records, F.col("bytes") + 16, [F.col("text_key"), F.col("doc_id")], SHARDS)
    return shards.select(
        "row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchor_simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return gumbel_pieces.sampled(docs).select("row.doc_id", *gumbel_pieces.COLUMNS)


def op11_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_gam, op2_warc, op3_hmm_lm, op4_adaptive_rules, op5_cross_polytope, op6_pareto_mix, op7_style_tree,
        op8_splitter_shards, op9_anchor_simhash, op10_gumbel_pieces, op11_hnsw, op12_token_alignment,
        op13_spelling_variants,
    )
}
