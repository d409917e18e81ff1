"""The corpus pipeline: language ID, exact dedup, near-duplicate join, source mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; ``run`` writes every stage's result as Parquet into the shared
folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import bpe, exact_dedup, jaccard, langid, mixing
from tillcast.llm.common import prepare, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compression classifier does not reject (null, no letters, narrow lead: gone)."""
    prepare(spark)
    return langid.accepted(docs, langid.fit(docs.where(~langid.held_out())))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to white space) the one with the smallest doc_id."""
    prepare(spark)
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 3-word shingles at Jaccard 0.9, the one with the smallest doc_id."""
    prepare(spark)
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights of their sources, globally shuffled; the columns of documents."""
    return mixing.mix(docs, mixing.WEIGHTS, other_weight=mixing.OTHER_WEIGHT, seed=mixing.SEED).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per (replicated) document: its ids, their number and the digests of ids and decoded text."""
    prepare(spark)
    return bpe.encode(docs).select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokens),
]

#: Compression, byte-pair merging and the join have no SQL form; tests compare with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
