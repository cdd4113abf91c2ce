"""Tables that grow by waves, and a crawl that is cut short between any two of its writes."""

import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from linkloom.operators.linkgraph import inlink_count
from linkloom.plans import crawl
from linkloom.sources.growing import GrowingTable


def test_few_parts_after_many_waves(spark):
    draw = random.Random(1)
    table, sums = GrowingTable(), GrowingTable(key="url", total="n")
    rows, by_wave, branches = [], {}, []
    for wave in range(26):
        new = [(draw.choice("abcdefgh") * draw.randrange(1, 4), draw.randrange(5)) for _ in range(draw.choice([0, 1, 3, 40]))]
        new += new[:1]
        df = spark.createDataFrame(new, "url string, n int")
        table = table.add(df, wave, written=True)
        if wave % 3 == 0:
            sums = sums.add(df.groupBy("url").agg(F.sum("n").alias("n")), wave)
        rows, by_wave[wave] = rows + new, new
        branches.append(len(table.parts))
    assert Counter(map(tuple, table.rows().collect())) == Counter(rows)
    assert Counter(map(tuple, table.rows(after=19).collect())) == Counter(r for w in range(20, 26) for r in by_wave[w])
    assert table.rows(after=25).count() == 0
    assert max(branches) <= 10 and sum(p.size for p in table.parts) == len(rows)
    sizes = [p.size for p in table.parts]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    want = Counter()
    for url, n in (r for w in range(0, 26, 3) for r in by_wave[w]):
        want[url] += n
    keys = spark.createDataFrame([("a",), ("bb",), ("ccc",), ("none",)], "url string")
    assert dict(map(tuple, sums.sums_of(keys).collect())) == {k: want[k] for k in ("a", "bb", "ccc") if k in want}
    assert sums.parts[0].size <= 24
    with pytest.raises(ValueError):
        sums.rows(after=3)


SITE = {f"http://s.org/{k}": f'<title>t{k}</title><p>page <a href="/{2 * k + 1}">x</a> <a href="/{2 * k + 2}">y</a> <a href="/{k // 3}">z</a></p>'
        for k in range(12)}
RULES = crawl.CrawlRules(boilerplate=[], scope="all", relevance=None, batch_step=2)


def shown(state):
    tables = {n: sorted(map(tuple, getattr(state, n).collect())) for n in ("frontier", *crawl.CrawlState.GROWING)}
    return tables, state.fetched, state.handed_out, state.metrics


@pytest.fixture(scope="module")
def pages(spark):
    return crawl.captured(spark.createDataFrame(list(SITE.items()), "url string, html string")).coalesce(1).checkpoint()


@pytest.fixture(scope="module")
def seeds(spark):
    return spark.createDataFrame([("http://s.org/0",)], "url string")


@pytest.fixture(scope="module")
def whole(spark, pages, seeds):
    return crawl.crawl(crawl.start(seeds, RULES), pages, RULES, max_waves=3)


def test_counts_by_wave_equal_a_recount(spark, whole):
    counts = whole.inlinks.sums_of(whole.edges.select(F.col("dst").alias("url")).distinct())
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, inlink_count(whole.edges).collect()))
    assert whole.iteration == 3 and whole.fetched > 4


class Cut(Exception):
    pass


@pytest.fixture(scope="module")
def waves(pages, seeds):
    """The states after one wave and after two."""
    first = crawl.crawl_wave(crawl.start(seeds, RULES), pages, RULES)
    return first, crawl.crawl_wave(replace(first, saved=1), pages, RULES)


@pytest.mark.parametrize("writes", [0, 1, 6, 8, 9])
def test_crawl_cut_between_two_writes(spark, pages, whole, waves, tmp_path, monkeypatch, writes):
    """The second wave ends after some of its writes: the first one's state holds until the marker is written."""
    paths = dict(docs_path=str(tmp_path / "docs"), state_path=str(tmp_path / "state"))
    assert crawl.committed_docs(spark, *paths.values()) is None
    first, second = waves
    crawl.write_wave(first, **paths)
    plain, left = DataFrameWriter.parquet, [writes]

    def parquet(self, *args, **options):
        if not left[0]:
            raise Cut
        left[0] -= 1
        return plain(self, *args, **options)

    with monkeypatch.context() as patched:
        patched.setattr(DataFrameWriter, "parquet", parquet)
        if writes < 9:  # documents, frontier, five growing tables, metrics, marker
            with pytest.raises(Cut):
                crawl.write_wave(second, **paths)
        else:
            crawl.write_wave(second, **paths)
            assert left == [0]
    expected = second if writes == 9 else first
    loaded = crawl.CrawlState.load(spark, paths["state_path"])
    assert shown(loaded) == shown(expected)
    assert crawl.committed_docs(spark, *paths.values()).count() == expected.fetched
    if writes == 6:  # going on from there gives what an undisturbed crawl does
        resumed = crawl.crawl(loaded, pages, RULES, max_waves=2, **paths)
        assert shown(resumed) == shown(whole)
        docs = crawl.committed_docs(spark, *paths.values())
        assert docs.count() == docs.select("doc_id").distinct().count() == whole.fetched
        assert shown(crawl.CrawlState.load(spark, paths["state_path"])) == shown(whole)
