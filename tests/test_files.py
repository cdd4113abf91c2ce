import json

from pyspark.sql import functions as F

from linkloom.operators import linkgraph
from linkloom.plans import pagerank
from linkloom.sources import docfiles, graphfiles, lists
from linkloom.sources.tables import index_graph_scan


def test_lists(spark, tmp_path):
    (tmp_path / "terms").write_text("Core \nŌkuma\ncore\n\nlast")
    terms = lists.read_terms(spark, str(tmp_path / "terms"))
    assert lists.as_list(terms) == ["core", "ōkuma", "core", "", "last"]
    assert [r.term for r in lists.read_stop_words(spark, str(tmp_path / "terms"), to_lower=False).limit(1).collect()] == ["Core"]
    (tmp_path / "urls").write_text("HTTP://H.com/a#b\n")
    assert [r.url for r in lists.read_ignore_urls(spark, str(tmp_path / "urls")).collect()] == ["http://h.com/a"]


FILE = """junk
<DOC>
<DOCNO> u1 </DOCNO>
<HEAD>One</HEAD>
<HEAD>Two</HEAD>
<TEXT>
first é
</TEXT>
<TEXT>second</TEXT>
</DOC>
<DOC>
<TEXT>no id</TEXT>
</DOC>
<DOC>
<DOCNO>u2</DOCNO>
<TEXT>
   </TEXT>
</DOC>
<DOC><DOCNO>u3</DOCNO><TEXT>same line</TEXT></DOC>
"""


def test_read_documents(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "data_1").write_text(FILE, encoding="utf-8")
    rows = {r.doc_id: (r.title, r.text) for r in docfiles.read_documents(spark, str(tmp_path / "a")).collect()}
    assert rows == {"u1": ("One Two", "first é\nsecond"), "u3": ("", "same line")}
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "data_1").write_text(FILE, encoding="latin-1")
    rows = {r.doc_id: r.text for r in docfiles.read_documents(spark, str(tmp_path / "b"), "ISO-8859-1").collect()}
    assert rows["u1"] == "first é\nsecond"


def test_documents_written_and_read(spark, tmp_path):
    docs = spark.createDataFrame([("u1", "T", "a\nb"), ("u2", None, "c"), ("u3", "", "d")], "doc_id string, title string, text string")
    docfiles.write_documents(docs.repartition(2), str(tmp_path / "docs"))
    back = docfiles.read_documents(spark, str(tmp_path / "docs"))
    assert sorted(map(tuple, back.drop("source_file").collect())) == [("u1", "T", "a\nb"), ("u2", "", "c"), ("u3", "", "d")]
    assert "<HEAD>" not in docs.filter("doc_id = 'u3'").select(
        docfiles.format_document(F.col("doc_id"), F.col("title"), F.col("text"))).first()[0]


def test_first_file_keeps_its_text(spark):
    docs = spark.createDataFrame([("u", "", "b", "file_2"), ("u", "", "a", "file_1")], "doc_id string, title string, text string, source_file string")
    assert [tuple(r) for r in docfiles.first_of_each(docs).collect()] == [("u", "", "a")]


def test_headers(spark, tmp_path):
    pages = spark.createDataFrame([("u", {"Content-Type": "text/html"})], "url string, headers map<string,string>")
    docfiles.write_headers(pages, str(tmp_path / "h"))
    assert [r.value for r in spark.read.text(str(tmp_path / "h")).collect()] == [
        "<DOC>", "<DOCNO>u</DOCNO>", "<RESPONSE_HEADERS>", "<CONTENT-TYPE>text/html</CONTENT-TYPE>", "</RESPONSE_HEADERS>", "</DOC>"]


def test_link_graph_files(spark, tmp_path):
    graph = {"u}": {"outlinks": ["v", "{w"], "inlinks": [], "wave": 1, "score": 2.5, "inlink_score": 0.0},
             "v": {"outlinks": [], "inlinks": ["u}", "u}"]}, "{w": {"outlinks": [], "inlinks": ["u}"]}}
    (tmp_path / "g.json").write_text(json.dumps(graph, indent=1))
    rows = {r.url: r for r in graphfiles.read_link_graph(spark, str(tmp_path / "g.json")).collect()}
    assert set(rows) == set(graph)
    assert rows["u}"].outlinks == ["v", "{w"] and rows["u}"].score == 2.5 and rows["v"].inlinks == ["u}", "u}"]
    assert rows["v"].wave is None
    edges = spark.createDataFrame([("a", "b"), ("a", "c")], "src string, dst string")
    graphfiles.write_link_graph(linkgraph.link_adjacency(edges), str(tmp_path / "lines"))
    back = linkgraph.adjacency_edges(graphfiles.read_link_lines(spark, str(tmp_path / "lines")))
    assert sorted(map(tuple, back.collect())) == [("a", "b"), ("a", "c")]


def test_redirect_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"a": "b", "b": "a"}, indent=1))
    assert sorted(map(tuple, graphfiles.read_redirects(spark, str(tmp_path / "r.json")).collect())) == [("a", "b"), ("b", "a")]
    one = spark.createDataFrame([("a", "b")], "url string, other_url string")
    graphfiles.write_redirects(one, str(tmp_path / "r"))
    assert sorted(map(tuple, graphfiles.read_redirects(spark, str(tmp_path / "r")).collect())) == [("a", "b"), ("b", "a")]


def test_inlink_lines(spark, tmp_path):
    (tmp_path / "w").write_text("a b c b\nd\nb a\n")
    parsed = graphfiles.read_inlinks(spark, str(tmp_path / "w"))
    edges = graphfiles.inlink_edges(parsed)
    assert sorted(map(tuple, edges.collect())) == [("a", "b"), ("b", "a"), ("b", "a"), ("c", "a")]
    vertices = graphfiles.inlink_vertices(parsed)
    assert sorted(r.id for r in vertices.collect()) == ["a", "b", "c", "d"]
    assert [r.id for r in linkgraph.sink_vertices(edges, vertices).collect()] == ["d"]


def test_rank_lines(spark, tmp_path):
    nodes = spark.createDataFrame([(1, [2, 3], 0.25), (2, [], 1e-7)], "id long, adjacency array<long>, rank double")
    graphfiles.write_rank_lines(nodes, str(tmp_path / "lines"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ["1:[2,3]:0.25", "2:[]:1.0E-7"]
    assert sorted(graphfiles.read_rank_lines(spark, str(tmp_path / "lines")).collect()) == sorted(nodes.collect())


def test_generated_chain_file_ranks_with_truncated_mass(spark, tmp_path):
    path = str(tmp_path / "chain")
    graphfiles.write_rank_lines(pagerank.chain_table(pagerank.chain_nodes(spark, 3), 3), path)
    parsed = graphfiles.read_rank_lines(spark, path)
    assert parsed.filter("id = 3").first().adjacency == [0]
    layout = pagerank.lay_out(graphfiles.rank_line_edges(parsed), parsed.select("id"))
    ranks = {r.id: round(r["rank"], 10) for r in pagerank.fixed_rounds(layout, 4, mass_precision=1e-6).collect()}
    assert len(ranks) == 9 and (ranks[1], ranks[2], ranks[3]) == (.0593002111, .1164005572, .1576320628)


def test_reports(spark, tmp_path):
    report = spark.createDataFrame([("b", 2, 0.1, 1, 0), ("a", 1, 0.9, 2, 3)], "page string, rank int, score double, n_in long, n_out long")
    graphfiles.write_rank_report(report, str(tmp_path / "top"))
    lines = [line for f in (tmp_path / "top").glob("part-*") for line in f.read_text().splitlines()]
    assert lines == ["a 1 0.9 2 3", "b 2 0.1 1 0"]
    top = spark.createDataFrame([("b", 0.1), ("a", 0.9)], "id string, score double")
    graphfiles.write_hits_report(top, str(tmp_path / "hits"))
    assert [line for f in (tmp_path / "hits").glob("part-*") for line in f.read_text().splitlines()] == ["a\t0.9", "b\t0.1"]
    ranks = spark.createDataFrame([(i, i / 4) for i in (3, 0, 1, 2)], "id long, rank double")
    graphfiles.write_pairs(ranks, str(tmp_path / "pairs"), first=2)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "pairs")).collect()) == ["(0,0.0)", "(1,0.25)"]
    graphfiles.write_rank_csv(ranks, str(tmp_path / "csv"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "csv")).collect())[0] == "0,0.0"


def test_index_scan_reads_only_link_fields(spark, tmp_path):
    rows = [("a", "text", ["b"], [], "X")]
    spark.createDataFrame(rows, "doc_id string, text string, inlinks array<string>, outlinks array<string>, author string").write.parquet(str(tmp_path / "i"))
    scan = index_graph_scan(spark.read.parquet(str(tmp_path / "i")))
    assert scan.first().is_sink
    assert "text" not in scan._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
