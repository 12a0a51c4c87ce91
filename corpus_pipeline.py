"""From raw documents to training pieces: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import adaptive_rules, anchor_simhash, gumbel_pieces, pareto_mix, quality_gam
from siltstone.llm.shared import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones among them, does not reject."""
    model = quality_gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.scored(docs, model).filter(F.col("score") >= quality_gam.THRESHOLD).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive thresholds keep."""
    return adaptive_rules.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return anchor_simhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return pareto_mix.mixed(docs)


def piece_sampling(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document: a row per document and sample."""
    return gumbel_pieces.sampled(docs.select("doc_id", "text", "lang", "source")).select("row.*", *gumbel_pieces.COLUMNS)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", piece_sampling),
]

#: A trained model, hashes and sampled lattices are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
