"""Files of the link graph and of rank vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import strip

ENTRY = "struct<inlinks:array<string>,outlinks:array<string>,wave:int,score:double,inlink_score:double>"


def write_link_graph(adjacency: DataFrame, path: str, mode: str = "error") -> None:
    """``url, inlinks, outlinks, …`` as JSON, one object per URL and line."""
    adjacency.write.mode(mode).json(path)


def read_link_graph(spark: SparkSession, path: str) -> DataFrame:
    """``url, inlinks, outlinks, wave, score, inlink_score``, from either form of the file.

    The form with one object over all URLs, indented by one space, is cut where an entry ends; its
    entries are then read by many tasks. The form with one object per line is read as it is.
    """
    raw = spark.read.option("lineSep", "\n },").text(path)
    body = F.regexp_replace("value", r"\n \}\s*\}\s*$", "")
    body = F.regexp_replace(body, r"^\s*\{", "")
    entry = F.from_json(F.concat(F.lit("{"), body, F.lit("}}")), f"map<string,{ENTRY}>")
    return raw.filter(F.trim("value") != "").select(F.explode(entry).alias("url", "e")).select("url", "e.*")


def read_link_lines(spark: SparkSession, path: str) -> DataFrame:
    """The line form written by :func:`write_link_graph`."""
    return spark.read.schema("url string, block int, inlinks array<string>, outlinks array<string>").json(path)


def read_redirects(spark: SparkSession, path: str) -> DataFrame:
    """``url, other_url`` of a JSON object with one pair per line."""
    lines = spark.read.text(path).select(F.regexp_replace(strip(F.col("value")), r"^\{|,$|\}$", "").alias("pair"))
    pairs = F.from_json(F.concat(F.lit("{"), F.col("pair"), F.lit("}")), "map<string,string>")
    return lines.filter("pair != ''").select(F.explode(pairs).alias("url", "other_url"))


def write_redirects(redirects: DataFrame, path: str, mode: str = "error") -> None:
    """Each pair in both directions, one object per line."""
    both = F.array(F.struct("url", "other_url"), F.struct(F.col("other_url").alias("url"), F.col("url").alias("other_url")))
    pairs = redirects.select(F.inline(both)).distinct()
    pairs.select(F.to_json(F.create_map("url", "other_url")).alias("value")).write.mode(mode).text(path)


def format_inlinks(url: Column, inlinks: Column) -> Column:
    """``page in1 in2 …``."""
    return F.concat_ws(" ", url, inlinks)


def parse_inlinks(lines: DataFrame) -> DataFrame:
    """``page, src`` for lines ``page in1 in2 …``; a page without inlinks has one row, ``src`` null.

    Fields are cut at single spaces and repeated inlinks are kept.
    """
    fields = F.split(strip(F.col("value")), " ")
    return lines.select(fields[0].alias("page"), F.explode_outer(F.slice(fields, F.lit(2), F.size(fields))).alias("src"))


def inlink_edges(parsed: DataFrame) -> DataFrame:
    return parsed.filter("src is not null").select("src", F.col("page").alias("dst"))


def inlink_vertices(parsed: DataFrame) -> DataFrame:
    """``id``: every page that heads a line or occurs in one."""
    ids = parsed.select(F.explode(F.array("page", "src")).alias("id"))
    return ids.filter("id is not null").distinct()


def read_inlinks(spark: SparkSession, path: str) -> DataFrame:
    return parse_inlinks(spark.read.text(path))


def format_rank_line(node: Column, adjacency: Column, rank: Column) -> Column:
    """``id:[a,b]:rank``."""
    return F.concat(node.cast("string"), F.lit(":["), F.array_join(adjacency.cast("array<string>"), ","), F.lit("]:"),
                    rank.cast("string"))


def parse_rank_lines(lines: DataFrame) -> DataFrame:
    """``id, adjacency, rank`` of lines ``id:[a,b]:rank``."""
    fields = F.split("value", ":")
    inner = F.regexp_replace(fields[1], r"[\[\]]", "")
    empty = F.array().cast("array<bigint>")
    adjacency = F.when(inner == "", empty).otherwise(F.split(inner, ",").cast("array<bigint>"))
    return lines.select(fields[0].cast("long").alias("id"), adjacency.alias("adjacency"),
                        fields[2].cast("double").alias("rank"))


def rank_line_edges(parsed: DataFrame, dummy: int = 0) -> DataFrame:
    """``src, dst`` of rank lines; a link to the dummy node stands for no link."""
    links = parsed.select(F.col("id").alias("src"), F.explode("adjacency").alias("dst"))
    return links.filter((F.col("dst") != dummy) & (F.col("src") != dummy))


def read_rank_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_rank_lines(spark.read.text(path))


def write_rank_lines(nodes: DataFrame, path: str, mode: str = "error") -> None:
    """``id, adjacency, rank`` as rank lines."""
    line = format_rank_line(F.col("id"), F.col("adjacency"), F.col("rank"))
    nodes.select(line.alias("value")).write.mode(mode).text(path)


def write_rank_csv(ranks: DataFrame, path: str, mode: str = "error") -> None:
    """``id,rank`` lines."""
    ranks.select("id", "rank").write.mode(mode).csv(path)


def format_report_line() -> Column:
    """``page rank score n_in n_out`` of a rank report."""
    return F.concat_ws(" ", "page", F.col("rank").cast("string"), F.col("score").cast("string"),
                       F.col("n_in").cast("string"), F.col("n_out").cast("string"))


def write_rank_report(report: DataFrame, path: str, mode: str = "error") -> None:
    """A rank report as one text file in rank order; it has no more rows than its top-k."""
    report.orderBy("rank").select(format_report_line().alias("value")).coalesce(1).write.mode(mode).text(path)


def write_hits_report(top: DataFrame, path: str, mode: str = "error") -> None:
    """``id, score`` of a top-k as one tab-separated file, best first."""
    top.orderBy(F.desc(F.round("score", 9)), "id").coalesce(1).write.mode(mode).csv(path, sep="\t")


def format_pair(node: Column, rank: Column) -> Column:
    """``(id,rank)``."""
    return F.concat(F.lit("("), node.cast("string"), F.lit(","), rank.cast("string"), F.lit(")"))


def write_pairs(ranks: DataFrame, path: str, first: int | None = None, mode: str = "error") -> None:
    """``(id,rank)`` lines by id: all of them, or the ``first`` smallest ids."""
    rows = ranks.orderBy("id")
    rows = rows.limit(first) if first else rows
    rows.select(format_pair(F.col("id"), F.col("rank")).alias("value")).write.mode(mode).text(path)
