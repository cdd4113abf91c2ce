"""Queries over link graphs derived from the order lines, and over the chain graph of the orders."""

from pyspark.sql import functions as F

from catalog import sqlparts as q
from linkloom.operators import index, linkgraph
from linkloom.plans import hits, pagerank
from linkloom.session import checkpoint
from linkloom.sources import tables
from linkloom.sources.tables import part_graph, part_pairs, read_table

PLACES = 9
ROUNDS = 5
CHAIN_ROW = 50
CHAIN_ROW_TRUNCATED = 11


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, PLACES) for c in columns})


def clean_edges(spark, folder):
    return linkgraph.clean_edges(part_pairs(spark, folder))


def graph_vertices(spark, folder):
    return linkgraph.graph_vertices(part_graph(spark, folder, suppliers=True))


def degrees(spark, folder):
    return linkgraph.degrees(part_pairs(spark, folder))


def inlink_count(spark, folder):
    return linkgraph.inlink_count(part_pairs(spark, folder))


def sink_vertices(spark, folder):
    return linkgraph.sink_vertices(part_graph(spark, folder, suppliers=True))


def sink_mass(spark, folder):
    edges = checkpoint(part_graph(spark, folder, suppliers=True))
    ranks = pagerank.fixed_rounds(pagerank.lay_out(edges, dedupe=False), 2)
    return rounded(linkgraph.sink_mass(ranks, linkgraph.sink_vertices(edges)), "mass")


def _joined(name):
    return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)


def link_adjacency(spark, folder):
    lists = linkgraph.link_adjacency(checkpoint(part_graph(spark, folder)))
    return lists.select("url", "block", _joined("inlinks"), _joined("outlinks"))


def new_links(spark, folder):
    from linkloom.operators.frontier import new_links as unseen

    found = part_graph(spark, folder, suppliers=True).select(F.col("dst").alias("url"))
    seen = linkgraph.graph_vertices(part_graph(spark, folder)).select(F.col("id").alias("url"))
    return unseen(found, seen)


def _redirects(spark, folder, target):
    return read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("url"), F.col("o_custkey").alias(target))


def redirect_resolve(spark, folder):
    return linkgraph.resolve_redirects(part_graph(spark, folder, suppliers=True), _redirects(spark, folder, "final_url"))


def doc_link_join(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    rows = checkpoint(linkgraph.link_rows(part_graph(spark, folder, suppliers=True)))
    linked = index.document_links(docs, rows, _redirects(spark, folder, "other_url"))
    return linked.select("doc_id", "direction", "link")


def index_upsert(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text", F.lit("first").alias("author"))
    items = read_table(spark, folder, "benchmark").select((F.col("item_id") * 50).alias("doc_id"), "text")
    merged = index.merge_documents(docs, items, author="second")
    return merged.select("doc_id", F.length("text").alias("n_chars"), "author")


def index_upsert_rows(spark, folder):
    def rows(suppliers):
        links = linkgraph.link_rows(part_graph(spark, folder, suppliers))
        return links.withColumn("pos", F.col("link"))

    return linkgraph.merge_link_rows(rows(False), rows(True))


def index_graph_scan(spark, folder):
    links = linkgraph.link_adjacency(checkpoint(part_graph(spark, folder, suppliers=True)))
    return tables.index_graph_scan(links.withColumnRenamed("url", "doc_id").withColumn("author", F.lit("first")))


def redirect_closure(spark, folder):
    """Each part redirects to the next higher part it is ordered with; the topmost, by their links, back or nowhere."""
    edges = linkgraph.edges_by_source(part_pairs(spark, folder))
    up = F.min(F.when(F.col("dst") > F.col("src"), F.col("dst")))
    steps = edges.groupBy(F.col("src").alias("url")).agg(
        F.coalesce(up, F.when(F.count("*") % 2 == 0, F.min("dst"))).alias("next_url"))
    return linkgraph.redirect_closure(steps)


_STEPS = (f"select * from (select src as url, coalesce(min(case when dst > src then dst end), case when count(*) % 2 = 0 then min(dst) end) as t "
          f"from ({q.edges()}) group by src) where t <> url")
_CLOSURE = (
    f"with recursive s as materialized ({_STEPS}), w as (select url, t as cur, [url] as path from s union all "
    "select w.url, s.t, list_append(path, cur) from w join s on s.url = w.cur where not list_contains(path, cur)), "
    "ends as (select url, arg_max(cur, len(path)) as cur, arg_max(path, len(path)) as path from w group by url) "
    "select url, case when list_contains(path, cur) then list_min(path[list_position(path, cur):]) else cur end as final_url, "
    "case when list_contains(path, cur) then null else len(path) end as hops from ends")


def pagerank_fixed(spark, folder):
    layout = pagerank.lay_out(part_pairs(spark, folder, suppliers=True))
    return rounded(pagerank.fixed_rounds(layout, ROUNDS), "rank")


def pagerank_top500(spark, folder):
    edges = checkpoint(part_graph(spark, folder))
    ranks = pagerank.fixed_rounds(pagerank.lay_out(edges, dedupe=False), ROUNDS)
    return rounded(pagerank.rank_report(ranks, edges, 500), "score")


def _crawled(spark, folder):
    return read_table(spark, folder, "lineitem").select(F.col("l_partkey").alias("id")).distinct()


def pagerank_crawled(spark, folder):
    # crawled are the parts; suppliers are known only as link targets
    edges = part_pairs(spark, folder, suppliers=True)
    crawled = _crawled(spark, folder)
    layout = pagerank.lay_out(edges, crawled, uncrawled="leak")
    return rounded(pagerank.fixed_rounds(layout, ROUNDS), "rank")


def pagerank_converged(spark, folder):
    layout = pagerank.lay_out(part_pairs(spark, folder, suppliers=True))
    ranks, _ = pagerank.until_converged(layout, stop="tol", tol=1e-13)
    return rounded(ranks, "rank")


def pagerank_histogram(spark, folder):
    layout = pagerank.lay_out(part_pairs(spark, folder, suppliers=True))
    ranks, done = pagerank.until_converged(layout, stop="histogram")
    return rounded(ranks, "rank").withColumn("updates", F.lit(done))


def _histogram_sql(most: int = 10) -> str:
    """Ranks after the update at which four perplexities in a row were the same."""
    parts = [q.rank_rounds(q.edges(True), q.vertices(True), most)]
    parts += [f"p{i} as materialized (select round(pow(2, sum(p * log2(p))), 6) as x from (select count(*)::double / (select count(*) "
              f"from r{i}) as p from r{i} group by round(r, 12)))" for i in range(most + 1)]
    same = [" and ".join(f"(select x from p{i}) = (select x from p{i - k})" for k in (1, 2, 3)) for i in range(3, most + 1)]
    cases = " ".join(f"when {c} then {i}" for i, c in enumerate(same, 3))
    parts.append(f"stop as materialized (select case {cases} end as i)")
    return ", ".join(parts) + " " + " union all ".join(
        f"select id, round(r, 9) as rank, {i} as updates from r{i} where (select i from stop) = {i}" for i in range(3, most + 1))


def _nodes(spark, folder):
    return read_table(spark, folder, "orders").select((F.col("o_orderkey") + 1).alias("id"))


def chain_graph(spark, folder):
    return pagerank.chain_edges(_nodes(spark, folder), CHAIN_ROW)


def _chain_ranks(spark, folder):
    return pagerank.with_dummy(pagerank.fixed_rounds(pagerank.lay_out_chain(_nodes(spark, folder), CHAIN_ROW), 10))


def chain_rank_first20(spark, folder):
    return rounded(_chain_ranks(spark, folder).orderBy("id").limit(20), "rank")


def chain_rank_sorted(spark, folder):
    return rounded(_chain_ranks(spark, folder).orderBy("id"), "rank")


def pagerank_truncated(spark, folder):
    layout = pagerank.lay_out_chain(_nodes(spark, folder), CHAIN_ROW_TRUNCATED)
    return rounded(pagerank.with_dummy(pagerank.fixed_rounds(layout, 4, mass_precision=1e-6)), "rank")


def _ranks(spark, folder, rounds):
    return pagerank.fixed_rounds(pagerank.lay_out(part_pairs(spark, folder, suppliers=True)), rounds)


def rank_histogram(spark, folder):
    return pagerank.rank_histogram(_ranks(spark, folder, 3), 9)


def rank_perplexity(spark, folder):
    return rounded(pagerank.perplexity(_ranks(spark, folder, 3), 9), "perplexity")


def _base(spark, folder, edges):
    root = linkgraph.graph_vertices(edges).orderBy(F.md5(F.col("id").cast("string")), "id").limit(20)
    return hits.base_set(edges, root, sample=200)


def hits_base_set(spark, folder):
    edges = checkpoint(part_graph(spark, folder, suppliers=True))
    return _base(spark, folder, edges)


def hits_subgraph(spark, folder):
    return hits.subgraph(part_graph(spark, folder, suppliers=True), _crawled(spark, folder))


def _hits(spark, folder, normalize, **stop):
    return hits.hits(part_pairs(spark, folder, suppliers=True), _crawled(spark, folder), normalize=normalize, **stop)


def hits_scores(spark, folder):
    return rounded(_hits(spark, folder, "sumsq", rounds=3), "hub", "authority")


def hits_l2(spark, folder):
    return rounded(_hits(spark, folder, "l2", rounds=3), "hub", "authority")


def hits_converged(spark, folder):
    return rounded(_hits(spark, folder, "l2", stop="tol", tol=1e-12), "hub", "authority")


def hits_top(spark, folder):
    edges = part_pairs(spark, folder)
    scores = hits.hits(edges, rounds=3, normalize="l2")
    top = [rounded(hits.hits_top(scores, n, 500), "score").select(F.lit(n).alias("kind"), "id", "score") for n in ("hub", "authority")]
    return top[0].unionByName(top[1])


_E, _S = q.edges(), q.edges(True)
_VS = q.vertices(True)
_LIST = "string_agg({0}::varchar, ',' order by {0})"


def _lists_sql(edges: str) -> str:
    return (f"select id as url, coalesce(i.l, []) as inlinks, coalesce(o.l, []) as outlinks from "
            f"(select src as id from ({edges}) union select dst from ({edges})) v "
            f"left join (select dst, list(src order by src) as l from ({edges}) group by dst) i on i.dst = v.id "
            f"left join (select src, list(dst order by dst) as l from ({edges}) group by src) o on o.src = v.id")


def _text_list(expr: str, name: str) -> str:
    return f"array_to_string({expr}, ',') as {name}"


_NODES = "select o_orderkey + 1 as id from orders"
_CHAIN = f"select * from ({q.chain(CHAIN_ROW)}) where dst > 0"
_CHAIN_T = f"select * from ({q.chain(CHAIN_ROW_TRUNCATED)}) where dst > 0"
_CHAIN_RANKS = f"{q.rank_rounds(_CHAIN, _NODES, 10)} select * from (select id, round(r, 9) as rank from r10 union all select 0, 0.0::double)"
_ROOT = f"select id from ({_VS}) order by md5(id::varchar), id limit 20"
_CRAWLED = "select distinct l_partkey as id from lineitem"
_PAIRS_IN = f"select src, dst from ({q.pairs(True)}) where src in ({_CRAWLED}) and dst in ({_CRAWLED})"


def _crawled_sql() -> str:
    # out-degrees count links to pages outside, which keep what they get
    rounds = q.rank_rounds(f"select src, dst from ({_S}) where src in ({_CRAWLED})", _CRAWLED, ROUNDS)
    return f"{rounds} select id, round(r, 9) as rank from r{ROUNDS}"


def _row_merge_sql() -> str:
    def rows(edges):
        return (f"select src as url, 'out' as direction, dst as link, dst as pos from ({edges}) union all "
                f"select dst, 'in', src, src from ({edges})")

    return (f"with old as materialized ({rows(_E)}), new as materialized ({rows(_S)}), "
            "ends as (select url, direction, max(pos) + 1 as after from old group by url, direction) "
            "select url, direction, pos, link from old union all "
            "select url, direction, pos + coalesce(after, 0), link from new left join ends using (url, direction) "
            "where not exists (select 1 from old o where o.url = new.url and o.direction = new.direction and o.link = new.link)")


ENTRIES = {
    "clean_edges": (clean_edges, _E),
    "graph_vertices": (graph_vertices, _VS),
    "degrees": (
        degrees,
        f"select id, sum(i)::bigint as in_degree, sum(o)::bigint as out_degree from (select src as id, 0 as i, 1 as o from ({_E}) "
        f"union all select dst, 1, 0 from ({_E})) group by id"),
    "inlink_count": (inlink_count, f"select dst as url, count(*) as n_inlinks from ({q.pairs()}) group by dst"),
    "sink_vertices": (sink_vertices, f"select id from ({_VS}) except select src from ({_S})"),
    "sink_mass": (
        sink_mass, f"{q.rank_rounds(_S, _VS, 2)} select round(sum(r), 9) as mass from r2 where id not in (select src from o)"),
    "link_adjacency": (
        link_adjacency,
        f"select url, 0 as block, {_text_list('inlinks', 'inlinks')}, {_text_list('outlinks', 'outlinks')} from ({_lists_sql(_E)})"),
    "new_links": (new_links, f"select dst as url from ({_S}) except select id from ({q.vertices()})"),
    "redirect_resolve": (
        redirect_resolve,
        f"select coalesce(a.o_custkey, src) as src, coalesce(b.o_custkey, dst) as dst from ({_S}) "
        "left join orders a on a.o_orderkey = src left join orders b on b.o_orderkey = dst"),
    "doc_link_join": (
        doc_link_join,
        f"with r as materialized (select src as url, 'out' as direction, dst as link from ({_S}) union all select dst, 'in', src from ({_S})), "
        "known as materialized (select distinct url from r), "
        "place as (select doc_id, case when k.url is not null then doc_id else o_custkey end as url from documents "
        "left join known k on k.url = doc_id left join orders on o_orderkey = doc_id) "
        "select doc_id, direction, link from place join r using (url)"),
    "index_upsert": (
        index_upsert,
        "select coalesce(o.doc_id, i.item_id * 50) as doc_id, length(coalesce(o.text, i.text)) as n_chars, "
        "case when o.doc_id is null then 'second' when i.item_id is null then 'first' else 'first second' end as author "
        "from documents o full outer join benchmark i on o.doc_id = i.item_id * 50"),
    "index_upsert_rows": (index_upsert_rows, _row_merge_sql()),
    "index_graph_scan": (
        index_graph_scan,
        f"select url as doc_id, len(inlinks) as n_in, len(outlinks) as n_out, 'first' as author, len(outlinks) = 0 as is_sink from ({_lists_sql(_S)})"),
    "redirect_closure": (redirect_closure, _CLOSURE),
    "pagerank_fixed": (pagerank_fixed, f"{q.rank_rounds(_S, _VS, ROUNDS)} select id, round(r, 9) as rank from r{ROUNDS}"),
    "pagerank_top500": (
        pagerank_top500,
        f"{q.rank_rounds(_E, q.vertices(), ROUNDS)}, top as (select id, r, row_number() over (order by round(r, 9) desc, id) as k from r{ROUNDS}) "
        "select id as page, k as rank, round(r, 9) as score, (select count(*) from e where dst = id) as n_in, "
        "(select count(*) from e where src = id) as n_out from top where k <= 500"),
    "pagerank_crawled": (pagerank_crawled, _crawled_sql()),
    "pagerank_converged": (
        pagerank_converged, f"{q.rank_rounds(_S, _VS, 60)} select id, round(r, 9) as rank from r60"),
    "pagerank_histogram": (pagerank_histogram, _histogram_sql()),
    "chain_graph": (chain_graph, q.chain(CHAIN_ROW)),
    "chain_rank_first20": (chain_rank_first20, f"{_CHAIN_RANKS} order by id limit 20"),
    "chain_rank_sorted": (chain_rank_sorted, f"{_CHAIN_RANKS} order by id"),
    "pagerank_truncated": (
        pagerank_truncated,
        f"{q.rank_rounds(_CHAIN_T, _NODES, 4, 1e-6)} select id, round(r, 9) as rank from r4 union all select 0, 0.0::double"),
    "rank_histogram": (
        rank_histogram, f"{q.rank_rounds(_S, _VS, 3)} select round(r, 9) as value, count(*) as n from r3 group by 1"),
    "rank_perplexity": (
        rank_perplexity,
        f"{q.rank_rounds(_S, _VS, 3)} select round(pow(2, sum(p * log2(p))), 9) as perplexity from "
        "(select count(*)::double / (select count(*) from r3) as p from r3 group by round(r, 9))"),
    "hits_base_set": (hits_base_set, f"{q.base_rounds(_S, _ROOT, 6, 200)} select id from b6"),
    "hits_subgraph": (hits_subgraph, f"select distinct src, dst from ({_PAIRS_IN})"),
    "hits_scores": (
        hits_scores,
        f"{q.hits_rounds(_PAIRS_IN, _CRAWLED, 3, False)} select id, round(hub, 9) as hub, round(authority, 9) as authority from h3"),
    "hits_l2": (
        hits_l2,
        f"{q.hits_rounds(_PAIRS_IN, _CRAWLED, 3, True)} select id, round(hub, 9) as hub, round(authority, 9) as authority from h3"),
    "hits_converged": (
        hits_converged,
        f"{q.hits_rounds(_PAIRS_IN, _CRAWLED, 40, True)} select id, round(hub, 9) as hub, round(authority, 9) as authority from h40"),
    "hits_top": (
        hits_top,
        f"{q.hits_rounds(q.pairs(), q.vertices(), 3, True)} "
        "select * from (select 'hub' as kind, id, round(hub, 9) as score from h3 order by score desc, id limit 500) union all "
        "select * from (select 'authority' as kind, id, round(authority, 9) as score from h3 order by score desc, id limit 500)"),
}
