"""Queries that write a text format and read it back."""

from pyspark.sql import functions as F

from catalog import sqlparts as q
from linkloom.operators import linkgraph
from linkloom.session import checkpoint
from linkloom.sources import docfiles, graphfiles
from linkloom.sources.tables import part_graph, read_table


def _titled(spark, folder):
    docs = read_table(spark, folder, "documents")
    title = F.when(F.col("lang") == "de", F.lit("")).otherwise(F.concat_ws(" ", "source", "lang"))
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), title.alias("title"), "text")


def doc_format(spark, folder):
    docs = _titled(spark, folder)
    return docs.select("doc_id", docfiles.format_document(F.col("doc_id"), F.col("title"), F.col("text")).alias("block"))


def doc_roundtrip(spark, folder):
    blocks = doc_format(spark, folder).select(F.explode(F.split("block", "</DOC>")).alias("value"))
    return docfiles.parse_documents(blocks)


def inlink_adjacency_roundtrip(spark, folder):
    lists = linkgraph.link_adjacency(checkpoint(part_graph(spark, folder)))
    line = graphfiles.format_inlinks(F.col("url").cast("string"), F.col("inlinks").cast("array<string>"))
    return graphfiles.inlink_edges(graphfiles.parse_inlinks(lists.select(line.alias("value"))))


def rank_line_roundtrip(spark, folder):
    edges = checkpoint(part_graph(spark, folder, suppliers=True))
    # a hub has several lines, each with the rank of the whole page
    lists = linkgraph.link_adjacency(edges).join(linkgraph.degrees(edges, distinct=False).withColumnRenamed("id", "url"), "url")
    line = graphfiles.format_rank_line(F.col("url"), F.col("outlinks"), F.lit(1.0) / (F.col("out_degree") + 1))
    parsed = graphfiles.parse_rank_lines(lists.select(line.alias("value")))
    links = parsed.select("id", F.explode("adjacency").alias("dst"))
    return parsed.select("id", F.round("rank", 9).alias("rank")).distinct().join(links, "id", "left")


_TITLE = "case when lang = 'de' then '' else source || ' ' || lang end"
_BLOCK = ("'<DOC>' || chr(10) || '<DOCNO>' || doc_id || '</DOCNO>' || chr(10) || "
          f"case when lang = 'de' then '' else '<HEAD>' || ({_TITLE}) || '</HEAD>' || chr(10) end || "
          "'<TEXT>' || chr(10) || text || chr(10) || '</TEXT>' || chr(10) || '</DOC>'")

ENTRIES = {
    "doc_format": (doc_format, f"select doc_id::varchar as doc_id, {_BLOCK} as block from documents"),
    "doc_roundtrip": (
        doc_roundtrip,
        f"select doc_id::varchar as doc_id, {_TITLE} as title, {q.strip('text')} as text from documents where {q.strip('text')} <> ''"),
    "inlink_adjacency_roundtrip": (
        inlink_adjacency_roundtrip, f"select src::varchar as src, dst::varchar as dst from ({q.edges()})"),
    "rank_line_roundtrip": (
        rank_line_roundtrip,
        f"select id, dst, round(1.0::double / (count(dst) over (partition by id) + 1), 9) as rank "
        f"from ({q.vertices(True)}) v left join ({q.edges(True)}) e on e.src = v.id"),
}
