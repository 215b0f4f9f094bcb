"""From documents to packed sequences: toxicity, near duplicates, repeated strings, benchmark passages, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import decontaminate, ngram_join, packing, queries, suffix_dedup, toxicity
from catalith.llm.common import shared_dir
from catalith.session import table

#: SQL can't express the stages; their tests compare them with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores under 0.5; it is learned from the labels outside of the held-out fold. Null and empty
    texts stay, repeated rows are judged alike, an empty table stays empty; columns may have any names."""
    fold = toxicity.hashed_remainder("doc_id", queries.TOXIC_FOLDS)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=fold != queries.TOXIC_HELD)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    return toxicity.score(rows, lexicon, out="_score").filter("_score < 0.5").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with a similarity of 0.75 on five-word shingles, the one with the smallest id.
    Null and blank texts all stay; of repeated rows one does."""
    return ngram_join.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that an earlier text or place has; n_chars follows.
    All rows stay, also those that are left empty; null texts stay null."""
    return suffix_dedup.deduplicate(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark passage; null and empty texts stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset; a null or empty text is one id."""
    return packing.pack(docs, queries.vocabulary(), added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeats),
    ("benchmark passages", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between two of them the rows are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        at = f"{shared_dir(spark)}/catalith-{spark.sparkContext.applicationId}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
