import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.operators import index, linkgraph
from linkloom.plans import hits, pagerank
from linkloom.session import steady_plans


def values(df, *names, places=10):
    return {r[0]: tuple(round(r[n], places) for n in names) if len(names) > 1 else round(r[names[0]], places)
            for r in df.collect()}


@pytest.mark.parametrize("hub_block", [1_000_000, 1])
def test_one_round(spark, toy, hub_block):
    layout = pagerank.lay_out(toy, hub_block=hub_block)
    assert values(pagerank.fixed_rounds(layout, 1), "rank") == {"A": .234, "B": .149, "C": .404, "D": .064, "E": .149}


def test_histogram_stop(spark, toy):
    ranks, updates = pagerank.until_converged(pagerank.lay_out(toy), stop="histogram")
    assert updates == 5
    assert values(ranks, "rank") == {"A": .3563207629, "B": .1910087936, "C": .3545738212, "D": .0402332353, "E": .0578633869}


def test_tolerance_stop_keeps_the_mass(spark, toy):
    ranks, updates = pagerank.until_converged(pagerank.lay_out(toy), tol=1e-3)
    assert 5 < updates < 60
    assert round(sum(values(ranks, "rank").values()), 9) == 1


def test_empty_graph(spark, toy):
    layout = pagerank.lay_out(toy.limit(0))
    assert pagerank.fixed_rounds(layout, 2).collect() == []
    assert hits.hits(toy.limit(0), rounds=2).collect() == []


def test_repeated_links_count_once(spark, toy):
    twice = toy.unionByName(toy)
    assert values(pagerank.fixed_rounds(pagerank.lay_out(twice), 2), "rank") == values(
        pagerank.fixed_rounds(pagerank.lay_out(toy), 2), "rank")


def test_uncrawled_targets_leak_or_are_dropped(spark, toy):
    crawled = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "id string")
    leak = values(pagerank.fixed_rounds(pagerank.lay_out(toy, crawled), 1), "rank")
    drop = values(pagerank.fixed_rounds(pagerank.lay_out(toy, crawled, uncrawled="drop"), 1), "rank")
    assert leak["C"] == round(.0375 + .85 * (.125 + .25 + .125), 10) and sum(leak.values()) < 1
    assert drop["C"] == round(.0375 + .85 * (.125 + .25 + .25), 10) and round(sum(drop.values()), 9) == 1


@pytest.mark.parametrize("rounds, expected", [
    (1, (.0481481481, .1425925926, .1425925926)), (4, (.0593003172, .1164007287, .1576322874)),
    (10, (.0614325667, .1137330634, .1581677032))])
def test_chain(spark, rounds, expected):
    nodes = pagerank.chain_nodes(spark, 3)
    implicit = values(pagerank.fixed_rounds(pagerank.lay_out_chain(nodes, 3), rounds), "rank")
    assert tuple(implicit[i] for i in (1, 2, 3)) == expected
    edges = pagerank.chain_edges(nodes, 3).filter("dst > 0")
    assert values(pagerank.fixed_rounds(pagerank.lay_out(edges), rounds), "rank") == implicit


def test_chain_k100(spark):
    ranks = pagerank.fixed_rounds(pagerank.lay_out_chain(pagerank.chain_nodes(spark, 100), 100), 10)
    assert ranks.filter("id = 1").first()["rank"] == pytest.approx(1.58881e-05, rel=1e-5)


def test_truncated_mass(spark):
    layout = pagerank.lay_out_chain(pagerank.chain_nodes(spark, 3), 3)
    ranks = values(pagerank.fixed_rounds(layout, 4, mass_precision=1e-6), "rank")
    assert (ranks[1], ranks[2], ranks[3]) == (.0593002111, .1164005572, .1576320628)
    assert round(sum(ranks.values()), 9) == round(.9999984934, 9)


def test_perplexity_of_equal_scores(spark, toy):
    layout = pagerank.lay_out(toy)
    assert pagerank.perplexity(pagerank.start_ranks(layout)).first()[0] == 1.0
    assert round(pagerank.perplexity(pagerank.fixed_rounds(layout, 1)).first()[0], 6) == .263902


def test_rank_report(spark, toy):
    ranks = pagerank.fixed_rounds(pagerank.lay_out(toy), 1)
    rows = pagerank.rank_report(ranks, toy, 4).orderBy("rank").collect()
    assert [(r.page, r["rank"], r.n_in, r.n_out) for r in rows] == [("C", 1, 3, 1), ("A", 2, 1, 2), ("B", 3, 1, 1), ("E", 4, 1, 0)]


@pytest.mark.parametrize("hub_block", [1_000_000, 1])
def test_hits_rounds(spark, toy, hub_block):
    run = lambda n: values(hits.hits(toy, rounds=n, normalize="sumsq", hub_block=hub_block), "hub", "authority")
    assert run(1) == {"A": (.2, .0833333333), "B": (.1, .0833333333), "C": (.1, .25), "D": (.2, 0), "E": (0, .0833333333)}
    assert run(2) == {"A": (1.1428571429, .2941176471), "B": (.8571428571, .5882352941),
                      "C": (.2857142857, 1.4705882353), "D": (1.1428571429, 0), "E": (0, .5882352941)}


def test_hits_scales_keep_the_order(spark, toy):
    order = {}
    for scale in ("sumsq", "l2"):
        scores = hits.hits(toy, rounds=6, normalize=scale)
        order[scale] = [[r.id for r in hits.hits_top(scores, name).collect()][:3] for name in ("hub", "authority")]
    assert order["sumsq"] == order["l2"]


def test_hits_counts_repeated_links(spark):
    edges = spark.createDataFrame([("A", "B"), ("A", "B"), ("A", "C")], "src string, dst string")
    assert values(hits.hits(edges, rounds=1, normalize="sumsq"), "authority")["B"] == round(2 / 5, 10)


def test_hits_stops(spark, toy):
    for stop in ("tol", "histogram"):
        scores = hits.hits(toy, rounds=40, stop=stop, tol=1e-4)
        assert [r.id for r in hits.hits_top(scores, "authority", 1).collect()] == ["C"]


@pytest.mark.parametrize("hub_block", [1_000_000, 3])
def test_converged_hits_of_nearly_equal_parts_need_few_rounds(spark, monkeypatch, hub_block):
    # a full 6 x 6 and a full 5 x 7: plain rounds bring them apart by a seventieth each
    links = [(i, 10 + j) for i in range(6) for j in range(6)] + [(20 + i, 30 + j) for i in range(5) for j in range(7)]
    rounds, updated = [], hits._updated
    monkeypatch.setattr(hits, "_updated", lambda *a: rounds.append(1) or updated(*a))
    edges = spark.createDataFrame(links, "src long, dst long")
    pages = spark.createDataFrame([(i,) for i in (*range(6), *range(10, 16), *range(20, 25), *range(30, 37), 50)], "id long")
    got = values(hits.hits(edges, pages, stop="tol", tol=1e-12, hub_block=hub_block), "hub", "authority")
    part = round(1 / math.sqrt(6), 10)
    assert got == {i: (part * (i < 6), part * (10 <= i < 16)) for (i,) in pages.collect()}
    assert len(rounds) < 60


def test_converged_hits_are_the_leading_singular_vectors(spark):
    # plain rounds need some thousands here
    links = skewed_links()
    ids = sorted({i for link in links for i in link})
    counts = np.zeros((len(ids), len(ids)))
    for src, dst in links:
        counts[ids.index(src), ids.index(dst)] += 1
    left, _, right = np.linalg.svd(counts)
    want = {i: (round(abs(left[k, 0]), 9), round(abs(right[0, k]), 9)) for k, i in enumerate(ids)}
    got = hits.hits(spark.createDataFrame(links, "src long, dst long"), stop="tol", tol=1e-12, hub_block=7)
    assert values(got, "hub", "authority", places=9) == want


def test_converged_hits_end_where_equal_parts_take_turns(spark):
    # one page with four links out, one with four links in: the scores of even and odd rounds differ for ever
    links = [(0, i) for i in range(1, 5)] + [(i, 10) for i in range(11, 15)]
    got = values(hits.hits(spark.createDataFrame(links, "src long, dst long"), stop="tol", tol=1e-12), "hub", "authority")
    part = round(1 / math.sqrt(5), 10)
    assert got == {i: (part * (i == 0 or i > 10), part * (0 < i <= 10)) for i in (*range(5), *range(10, 15))}


def test_converged_hits_keep_the_shares_of_equal_parts(spark, monkeypatch):
    # page 0, and page 1 with its 16, are stretched by 20 each, all others by less; two steps do not span that
    links = [(0, 0)] * 20 + [(1, 1)] * 19 + [(1, i) for i in range(2, 18)] + [(i, 1) for i in range(2, 18)]
    links += [(i, i) for i in range(2, 18) for _ in range(4)] + [(i, i) for i in range(20, 50) for _ in range(12)]
    monkeypatch.setattr(hits, "SPANNING_STEPS", 2)
    got = values(hits.hits(spark.createDataFrame(links, "src long, dst long"), stop="tol", tol=1e-12), "hub", "authority")
    alone, centre = 1, 2 / (1 + 1 / 16)  # what 1s have along (1), and along 1 and a sixteenth for each of the 16
    size = math.sqrt(alone ** 2 + centre ** 2 * (1 + 1 / 16))
    want = {0: alone / size, 1: centre / size} | {i: centre / 16 / size for i in range(2, 18)} | {i: 0 for i in range(20, 50)}
    assert got == {i: (round(x, 10), round(x, 10)) for i, x in want.items()}


def test_converged_hits_without_links(spark, toy):
    pages = spark.createDataFrame([("A",), ("Z",)], "id string")
    assert values(hits.hits(toy.limit(0), pages, stop="tol"), "hub", "authority") == {"A": (0, 0), "Z": (0, 0)}
    assert hits.hits(toy.limit(0), stop="tol").collect() == []


def test_base_set_grows_and_stops(spark, toy):
    root = spark.createDataFrame([("B",)], "id string")
    ids = lambda **kw: sorted(r.id for r in hits.base_set(toy, root, **kw).collect())
    assert ids(max_rounds=1) == ["A", "B", "C", "D"] or ids(max_rounds=1) == ["A", "B", "C"]
    assert ids() == ["A", "B", "C", "D", "E"]
    assert len(ids(sample=0, max_rounds=1)) == 2
    crawled = spark.createDataFrame([("A",), ("B",), ("C",)], "id string")
    assert ids(vertices=crawled) == ["A", "B", "C"]


def test_hub_adjacency_is_split_and_whole(spark):
    edges = spark.range(1, 101).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    lists = linkgraph.link_adjacency(edges, block=10)
    assert lists.filter("url = 0").count() > 1
    assert lists.agg(F.max(F.size("outlinks"))).first()[0] < 100
    assert linkgraph.adjacency_edges(lists).exceptAll(edges).count() == 0
    assert linkgraph.adjacency_edges(lists).count() == 100


def test_upsert(spark):
    held = spark.createDataFrame([("u", "old", ["a", "a", "b"], ["x"], "X")],
                                 "doc_id string, text string, inlinks array<string>, outlinks array<string>, author string")
    fresh = spark.createDataFrame([("u", "new", ["c", "b", "c"], ["x"]), ("v", "first", ["a"], [])],
                                  "doc_id string, text string, inlinks array<string>, outlinks array<string>")
    once = index.merge_links(held, fresh, "Y")
    rows = {r.doc_id: r for r in once.collect()}
    assert rows["u"].inlinks == ["a", "a", "b", "c"] and rows["u"].text == "old" and rows["u"].author == "X Y"
    assert rows["v"].text == "first" and rows["v"].author == "Y"
    twice = index.merge_links(once, fresh, "Y")
    assert sorted(twice.collect()) == sorted(once.collect())
    assert {r.doc_id: r.text for r in index.merge_links(held, fresh, "Y", refresh_text=True).collect()}["u"] == "new"


def test_row_upsert_equals_list_upsert(spark):
    held = spark.createDataFrame([("u", "in", i, x) for i, x in enumerate("aab")], "url string, direction string, pos long, link string")
    fresh = spark.createDataFrame([("u", "in", i, x) for i, x in enumerate("cbc")] + [("v", "in", 0, "a")],
                                  "url string, direction string, pos long, link string")
    rows = linkgraph.merge_link_rows(held, fresh).orderBy("url", "pos").collect()
    assert [(r.url, r.link) for r in rows] == [("u", "a"), ("u", "a"), ("u", "b"), ("u", "c"), ("v", "a")]


def test_link_info_through_the_redirect(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_id string")
    links = spark.createDataFrame([("a", ["x"], ["y"]), ("B", ["p"], [])], "url string, inlinks array<string>, outlinks array<string>")
    redirects = spark.createDataFrame([("b", "B"), ("B", "b"), ("a", "B")], "url string, other_url string")
    rows = {r.doc_id: r.inlinks for r in index.with_link_info(docs, links, redirects).collect()}
    assert rows == {"a": ["x"], "b": ["p"]}


def test_redirects_rename_both_ends(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    names = spark.createDataFrame([("b", "B")], "url string, final_url string")
    assert sorted(map(tuple, linkgraph.resolve_redirects(edges, names).collect())) == [("B", "c"), ("a", "B")]


def test_scores_go_to_the_entry_or_its_partner(spark):
    vertices = spark.createDataFrame([("a",), ("B",), ("z",)], "id string")
    scores = spark.createDataFrame([("a", 1, 2.0, 0.1), ("b", 2, 3.0, 0.2)], "url string, wave int, score double, inlink_score double")
    redirects = spark.createDataFrame([("b", "B"), ("B", "b")], "url string, other_url string")
    rows = {r.id: (r.wave, r.score) for r in linkgraph.write_back_scores(vertices, scores, redirects).collect()}
    assert rows == {"a": (1, 2.0), "B": (2, 3.0), "z": (None, None)}


def skewed_links():
    """400 links, a third of them from one page and a third to another."""
    draw = random.Random(3)
    links = {(0, draw.randrange(1, 300)) for _ in range(200)} | {(draw.randrange(2, 300), 1) for _ in range(200)}
    return sorted(links | {(draw.randrange(300), draw.randrange(300)) for _ in range(150)})


def test_skewed_ranks_against_brute_force(spark):
    links = skewed_links()
    ids = sorted({i for link in links for i in link})
    out = Counter(src for src, _ in links)
    rank = dict.fromkeys(ids, 1 / len(ids))
    for _ in range(4):
        lost = sum(r for i, r in rank.items() if not out[i])
        new = dict.fromkeys(ids, .15 / len(ids) + .85 * lost / len(ids))
        for src, dst in links:
            new[dst] += .85 * rank[src] / out[src]
        rank = new
    layout = pagerank.lay_out(spark.createDataFrame(links, "src long, dst long"), hub_block=7)
    assert "part" in layout.edges.columns
    assert values(pagerank.fixed_rounds(layout, 4), "rank") == {i: round(r, 10) for i, r in rank.items()}


def test_skewed_hits_against_brute_force(spark):
    links = skewed_links()
    hub = authority = dict.fromkeys({i for link in links for i in link}, 1.0)
    for _ in range(3):
        h, a = dict.fromkeys(hub, 0.0), dict.fromkeys(hub, 0.0)
        for src, dst in links:
            h[src] += authority[dst]
            a[dst] += hub[src]
        hub = {i: x / math.sqrt(sum(y * y for y in h.values())) for i, x in h.items()}
        authority = {i: x / math.sqrt(sum(y * y for y in a.values())) for i, x in a.items()}
    got = hits.hits(spark.createDataFrame(links, "src long, dst long"), rounds=3, hub_block=7)
    assert values(got, "hub", "authority") == {i: (round(hub[i], 10), round(authority[i], 10)) for i in hub}


def test_split_hubs_change_nothing(spark):
    from linkloom.sources import tables

    edges = spark.createDataFrame(skewed_links(), "src long, dst long")
    scans = []
    for block in (2, 10 ** 6):
        lists = linkgraph.link_adjacency(edges, block=block).withColumnRenamed("url", "doc_id").withColumn("author", F.lit("a"))
        scans.append(sorted(tables.index_graph_scan(lists).collect()))
    assert scans[0] == scans[1]


def test_document_links_of_a_hub(spark):
    edges = spark.createDataFrame(skewed_links(), "src long, dst long")
    docs = spark.createDataFrame([(0,), (1000,), (2000,)], "doc_id long")
    redirects = spark.createDataFrame([(1000, 0), (0, 5)], "url long, other_url long")
    rows = linkgraph.link_rows(edges)
    want = sorted((r.direction, r.link) for r in rows.filter("url = 0").collect())
    got = index.document_links(docs, rows, redirects).collect()
    assert {r.doc_id for r in got} == {0, 1000}
    for doc in (0, 1000):
        assert sorted((r.direction, r.link) for r in got if r.doc_id == doc) == want


def test_skewed_redirects_against_brute_force(spark):
    links = skewed_links()
    names = {0: 7, 1: 8, 5: 1}
    got = linkgraph.resolve_redirects(spark.createDataFrame(links, "src long, dst long"),
                                      spark.createDataFrame(list(names.items()), "url long, final_url long"))
    assert sorted(map(tuple, got.collect())) == sorted((names.get(a, a), names.get(b, b)) for a, b in links)


def test_the_last_node_of_a_broken_chain_keeps_the_mass(spark):
    nodes = spark.range(1, 16)
    ranks = pagerank.fixed_rounds(pagerank.lay_out_chain(nodes, 11), 4)
    assert round(sum(values(ranks, "rank").values()), 8) == 1


def test_tables_of_redirects_are_not_broadcast_on_a_guess(spark):
    edges = spark.createDataFrame(skewed_links(), "src long, dst long")
    names = spark.createDataFrame([(0, 7), (1, 8)], "url long, final_url long")
    plan = linkgraph.resolve_redirects(edges, names)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "explode" not in plan
    held = linkgraph.link_rows(edges).withColumn("pos", F.lit(0))
    plan = linkgraph.new_link_rows(held, held)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "explode" not in plan


def test_a_hot_key_is_dealt_in_pieces(spark):
    rows = spark.createDataFrame([(0, k) for k in range(50)] + [(None, k) for k in range(30)] + [(1, 1), (2, 2)], "k long, x long")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (3, "c")], "k long, v string")
    hot = linkgraph.hot_keys(rows, ["k"], 10)
    assert sorted(((r.k, r.pieces) for r in hot.collect()), key=str) == [(0, 5), (None, 3)]
    for how in ("left", "inner"):
        got = linkgraph.hot_join(rows, table, ["k"], "x", how, hot=hot)
        want = rows.join(table, "k", how)
        assert sorted(map(tuple, got.select("k", "x", "v").collect()), key=str) == sorted(
            map(tuple, want.select("k", "x", "v").collect()), key=str)


@pytest.mark.parametrize("hub_block", [1_000_000, 7])
def test_rounds_read_one_row_for_the_links_of_a_source(spark, monkeypatch, hub_block):
    monkeypatch.setattr("linkloom.session.ROWS_PER_PARTITION", 100)
    links = skewed_links()
    layout = pagerank.lay_out(spark.createDataFrame(links, "src long, dst long"), hub_block=hub_block)
    keys = [c for c in layout.edges.columns if c != "dsts"]
    assert layout.edges.count() == layout.edges.select(keys).distinct().count() < len(links)
    assert sorted(map(tuple, layout.edges.select("src", F.explode("dsts")).collect())) == links
    with steady_plans(spark, layout.width):
        plan = pagerank.next_ranks(layout, pagerank.start_ranks(layout))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 + ("part" in keys)


def test_links_of_a_source_lie_together_and_those_of_a_hub_in_several_ranges(spark):
    links = [(k % 300, 7 * k % 1000) for k in range(6000)] + [(1000, k) for k in range(6000)] + [(None, 3), (5, None)]
    edges = spark.createDataFrame(2 * links, "src long, dst long")
    with steady_plans(spark, 8):
        dealt = linkgraph.edges_by_source(edges)
        assert sorted(map(tuple, dealt.collect()), key=str) == sorted(set(links), key=str)
        places = Counter(r.src for r in dealt.select("src", F.spark_partition_id().alias("p")).distinct().collect())
    assert 2 < places.pop(1000) <= 8 and sum(places.values()) <= 301 + 8


def test_steps_of_redirects_move_a_row_for_each_url(spark, tmp_path, monkeypatch):
    from catalog import graph

    r = random.Random(5)
    lines = [(k // 4, k % 4, r.choice([None, 0, *range(100)]), 1) for k in range(8000)]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(linkgraph, "redirect_closure", lambda steps: steps)
    with steady_plans(spark, 8):
        steps = graph.redirect_closure(spark, str(tmp_path))
        got = {x.url: x.next_url for x in steps.collect()}
        plan = steps._jdf.queryExecution().executedPlan().toString()
    # the lines to their orders, the pairs to their ranges, then what the ranges know of each URL
    dealt = [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange " in line]
    assert [x.split("(")[0] for x in dealt] == ["hashpartitioning", "rangepartitioning", "hashpartitioning"]
    links = {}
    lines.sort(key=lambda x: (x[0], x[1]))
    for (order, _, src, _), (other, _, dst, _) in zip(lines, lines[1:]):
        if order == other and dst is not None:
            links.setdefault(src, set()).add(dst)
    want = {}
    for src, dsts in links.items():
        up = [d for d in dsts if src is not None and d > src]
        want[src] = min(up) if up else min(dsts) if len(dsts) % 2 == 0 else None
    assert got == want
