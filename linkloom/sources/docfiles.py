"""Document files: tagged text blocks, and the header records beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import strip


def format_document(doc_id: Column, title: Column, text: Column) -> Column:
    """One document as tagged lines; an empty title leaves its line out."""
    title = F.coalesce(title, F.lit(""))
    return F.concat_ws(
        "\n", F.lit("<DOC>"), F.concat(F.lit("<DOCNO>"), doc_id, F.lit("</DOCNO>")),
        F.when(title != "", F.concat(F.lit("<HEAD>"), title, F.lit("</HEAD>"))),
        F.lit("<TEXT>"), F.coalesce(text, F.lit("")), F.lit("</TEXT>"), F.lit("</DOC>"))


def format_headers(doc_id: Column, headers: Column) -> Column:
    """The response headers of one page as tagged lines, names in upper case."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(
        F.lit("<"), F.upper(e.key), F.lit(">"), e.value, F.lit("</"), F.upper(e.key), F.lit(">")))
    return F.concat_ws(
        "\n", F.lit("<DOC>"), F.concat(F.lit("<DOCNO>"), doc_id, F.lit("</DOCNO>")), F.lit("<RESPONSE_HEADERS>"),
        F.when(F.size(lines) > 0, F.array_join(lines, "\n")), F.lit("</RESPONSE_HEADERS>"), F.lit("</DOC>"))


def parse_documents(blocks: DataFrame, source: str | None = None) -> DataFrame:
    """``doc_id, title, text`` of blocks ``value`` that each end where ``</DOC>`` stood.

    Several heads are joined by a space, several texts follow each other; all three are stripped.
    A block without id or text is dropped, and only that block.
    """
    body = blocks.filter(F.contains("value", F.lit("<DOC>"))).withColumn(
        "body", F.regexp_extract("value", r"(?s)<DOC>(.*)$", 1))

    def parts(tag: str) -> Column:
        return F.regexp_extract_all("body", F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))

    doc = F.struct(
        strip(F.coalesce(F.try_element_at(parts("DOCNO"), F.lit(-1)), F.lit(""))).alias("doc_id"),
        strip(F.array_join(parts("HEAD"), " ")).alias("title"),
        strip(F.array_join(parts("TEXT"), "")).alias("text"))
    # as a generated row: the filter below would otherwise be moved under the patterns and repeat them
    docs = body.select(F.inline(F.array(doc)), *([source] if source else []))
    return docs.filter("doc_id != '' and text != ''")


def read_documents(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """``doc_id, title, text, source_file`` of document files.

    Files are read block by block, so that one large file is read by many tasks.
    """
    raw = spark.read.option("lineSep", "</DOC>").text(path)
    value = F.col("value") if charset.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    return parse_documents(raw.select(value.alias("value"), F.col("_metadata.file_path").alias("source_file")),
                           "source_file")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row per id: that of the first file by name, as a first insert keeps its text."""
    return docs.groupBy("doc_id").agg(F.min_by(F.struct("title", "text"), "source_file").alias("d")).select(
        "doc_id", "d.title", "d.text")


def write_documents(docs: DataFrame, path: str, mode: str = "error") -> None:
    """``doc_id, title, text`` as document files, one per task."""
    docs.select(format_document(F.col("doc_id"), F.col("title"), F.col("text")).alias("value")).write.mode(mode).text(path)


def write_headers(pages: DataFrame, path: str, mode: str = "error") -> None:
    """``url, headers`` as header records."""
    pages.select(format_headers(F.col("url"), F.col("headers")).alias("value")).write.mode(mode).text(path)
