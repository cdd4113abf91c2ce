"""One-entry-per-line files: term lists, stop words, URLs to ignore."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import strip
from linkloom.functions.urls import canonicalize


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``pos, value`` in file order; a list is one small file, read whole."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\r?\n$", "").alias("value"))
    return whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "value"))


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """``pos, term``: stripped, in lower case, in file order, repeated terms kept."""
    return _lines(spark, path).select("pos", F.lower(strip(F.col("value"))).alias("term"))


def read_stop_words(spark: SparkSession, path: str, to_lower: bool = True) -> DataFrame:
    """``term`` of a stop list."""
    term = strip(F.col("value"))
    return _lines(spark, path).select((F.lower(term) if to_lower else term).alias("term"))


def read_ignore_urls(spark: SparkSession, path: str) -> DataFrame:
    """``url``: canonical form of each line."""
    line = strip(F.col("value"))
    return _lines(spark, path).select(canonicalize(line, line).alias("url"))


def as_list(terms: DataFrame) -> list[str]:
    """A word list as parameter of the column functions, in file order."""
    column = terms.columns[-1]
    ordered = terms.orderBy("pos") if "pos" in terms.columns else terms
    return [row[column] for row in ordered.collect()]
