"""The training-data pipeline: each stage works on all documents its predecessor kept, written as Parquet between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import packing, rules, simhash, suffix, toxicity
from linkloom.llm.catalog import vocabulary
from linkloom.llm.common import MAX_ID, saved, table, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the network learns from the tables in ``sf_dir``."""
    net = toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    (score,) = unused(docs, "toxicity")
    return toxicity.scored(docs, net, score).filter(F.col(score) < toxicity.THRESHOLD).select(
        *[f"`{c}`" for c in docs.columns])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the latest policy over the rule ledger keeps."""
    return rules.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest id, null ids last; of rows equal in
    id and text one stays."""
    (key,) = unused(docs, "key")
    keyed = docs.select("*", F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_ID)).alias("id"),
                                      F.xxhash64("text").alias("hash")).alias(key))
    groups = simhash.near_duplicates(keyed.select(key, "text"), key=key)
    first = groups.groupBy("component_id").agg(F.count("*").alias("n")).select(F.col("component_id").alias(key))
    return keyed.join(first, key, "left_semi").dropDuplicates([key]).select(*[f"`{c}`" for c in docs.columns])


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has too."""
    return suffix.deduplicated(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
