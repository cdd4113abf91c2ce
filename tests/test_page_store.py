"""The page store, waves that read from it, and chains of redirects."""

import random
import re

import pytest

from linkloom.operators.linkgraph import redirect_closure
from linkloom.plans import crawl
from linkloom.sources.pagestore import PageStore


def site(n, k):
    return f"https://h{n % 3}.example.org/p{k}"


@pytest.fixture(scope="module")
def pages(spark):
    rows = []
    for k in range(120):
        links = "".join(f'<a href="{site(j, j)}">to {j}</a> ' for j in (2 * k + 1, 2 * k + 2, k))
        rows.append((k, site(k, k), f"<html><title>t{k}</title><body><p>Page {k} {links}</p></body></html>"))
    rows.append((500, site(7, 7) + "#later", "<html><body><p>Second capture.</p></body></html>"))
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


def test_lookup_reads_only_the_named_buckets(spark, pages, tmp_path):
    taken = crawl.captured(pages)
    store = PageStore.write(taken, str(tmp_path / "a"), buckets=16)
    wanted = spark.createDataFrame([(site(k, k), k) for k in (3, 7, 999)], "url string, tag int")
    found = store.lookup(wanted)
    rows = sorted((r.url, r.tag, r.capture) for r in found.collect())
    assert rows == sorted((site(k, k), k, k) for k in (3, 7))
    plan = found._jdf.queryExecution().executedPlan().toString()
    named = store.names.filter(store.names["url"].isin([site(3, 3), site(7, 7)])).select("bucket").distinct().count()
    chosen = re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan)
    assert len((chosen[1] or chosen[2]).split(",")) == named < 16
    assert store.lookup(wanted.filter("tag = 999")).collect() == []
    assert PageStore.write(taken.filter("false"), str(tmp_path / "b")).lookup(wanted).collect() == []


def test_waves_from_a_store_equal_waves_from_the_table(spark, pages, tmp_path):
    rules = crawl.CrawlRules(boilerplate=[], scope="all", relevance=None, batch_step=None)
    taken = crawl.captured(pages)
    seeds = spark.createDataFrame([(site(0, 0),)], "url string")
    plain = crawl.crawl(crawl.start(seeds, rules), taken, rules, max_waves=4)
    stored = crawl.crawl(crawl.start(seeds, rules), PageStore.write(taken, str(tmp_path), buckets=4), rules, max_waves=4)
    for name in ("scores", "edges", "completed", "frontier", "docs"):
        assert sorted(map(tuple, getattr(stored, name).collect())) == sorted(map(tuple, getattr(plain, name).collect())), name
    assert stored.fetched == 15


@pytest.mark.parametrize("n, seed", [(1, 0), (40, 1), (300, 2), (300, 3)])
def test_redirect_chains(spark, n, seed):
    r = random.Random(seed)
    step = {f"u{k:03}": f"u{r.randrange(n):03}" for k in range(n) if seed == 3 or r.random() < 0.93}
    if seed == 2:  # one long chain with a cycle at its end
        step = {f"u{k:03}": f"u{k + 1:03}" for k in range(n)} | {f"u{n:03}": "u290"}
    rows = [*step.items(), ("self", "self"), ("none", None), ("two", "u001"), ("two", "u000")]
    got = {x.url: (x.final_url, x.hops) for x in redirect_closure(spark.createDataFrame(rows, "url string, next_url string")).collect()}
    step = {a: b for a, b in step.items() if a != b} | {"two": "u000"}
    want = {}
    for url in step:
        path = [url]
        while path[-1] in step and step[path[-1]] not in path:
            path.append(step[path[-1]])
        turn = step.get(path[-1])
        want[url] = (path[-1], len(path) - 1) if turn is None else (min(path[path.index(turn):]), None)
    assert got == want
    assert redirect_closure(spark.createDataFrame([], "url string, next_url string")).collect() == []


def test_a_cycle_ends_without_going_round_the_whole_table(spark, monkeypatch):
    rows = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (999, 1001), (5000, 2000)]
    rows += [(2000 + k, 2000 + (k + 1) % 7) for k in range(7)]
    written = []
    monkeypatch.setattr("linkloom.operators.linkgraph.checkpoint", lambda df: written.append(df) or df.localCheckpoint())
    got = {r.url: (r.final_url, r.hops) for r in redirect_closure(spark.createDataFrame(rows[300:], "url long, next_url long")).collect()}
    want = {1000: (1000, None), 1001: (1000, None), 999: (1000, None), 5000: (2000, None)} | {2000 + k: (2000, None) for k in range(7)}
    assert got == want
    # the steps, then in each round the hot keys and the pointers: cycles of 7 are met twice in 16 steps
    assert len(written) <= 1 + 2 * 5
    chains = {r.url: (r.final_url, r.hops) for r in redirect_closure(spark.createDataFrame(rows, "url long, next_url long")).collect()}
    assert chains == want | {k: (300, 300 - k) for k in range(300)}


def test_many_redirects_to_one_hub(spark, monkeypatch):
    monkeypatch.setattr("linkloom.operators.linkgraph.HOT_ROWS", 10)
    rows = [(k, 1) for k in range(100, 200)] + [(1, 2), (2, 3), (3, 4), (4, 5)]
    got = {r.url: (r.final_url, r.hops) for r in redirect_closure(spark.createDataFrame(rows, "url long, next_url long")).collect()}
    assert got == {k: (5, 5) for k in range(100, 200)} | {k: (5, 5 - k) for k in range(1, 5)}
