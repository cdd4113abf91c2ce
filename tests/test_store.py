"""The stored index in versions: upserts, readers of old versions, compaction, and exact top-k search over blocks."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import index, search
from linkloom.operators.store import IndexStore

WORDS = "reactor core water power plant leak the of accident cooling tower grid".split()
HOW = {"stop_words": ["the", "of"], "stem": True}


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(1)
    rows = [(k, " ".join(r.choices(WORDS, weights=range(len(WORDS), 0, -1), k=r.choice([1, 3, 10, 40, 200])))) for k in range(1500)]
    return spark.createDataFrame([*rows, (2000, None), (2001, ""), (2002, "tower " * 500)], "doc_id long, text string").repartition(6)


@pytest.fixture(scope="module")
def store(spark, texts, tmp_path_factory):
    return IndexStore(spark, str(tmp_path_factory.mktemp("store")), **HOW).create(texts, "a")


def test_postings_are_made_without_a_shuffle(texts):
    for how in ({}, HOW):
        plan = index.postings(texts, **how).drop("positions")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # the fixture's own
    want = index.positioned_terms(texts, **HOW).groupBy("term", "doc_id", "doc_len").agg(
        F.count("*").alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions"))
    assert rows_of(index.postings(texts, **HOW)) == rows_of(want)


def test_blocks_hold_all_postings(store, texts):
    got = store.postings().select("term", "doc_id", "doc_len", F.col("tf").cast("long").alias("tf"), "positions")
    assert rows_of(got) == rows_of(index.postings(texts, **HOW))
    some = store.postings(["reactor", "core"])
    assert {r.term for r in some.select("term").distinct().collect()} == {"reactor", "core"}
    assert store.blocks().agg(F.max("n")).first()[0] < 1500 / 4


@pytest.mark.parametrize("query, k", [
    ("tower", 1), ("tower grid", 5), ("reactors accident", 10), ("core core cooling", 40), ("reactor", 5000), ("nothing", 3), ("the", 3)])
def test_search_equals_the_whole_scan(store, texts, query, k):
    found = store.search(query, k)
    want = search.best(search.bm25_documents(texts, query, **HOW), k)
    got = [(r.rank, r.doc_id, round(r.score, 9)) for r in found.rows.collect()]
    assert sorted(got) == sorted((r.rank, r.doc_id, round(r.score, 9)) for r in want.collect())
    assert found.ranges_read <= found.ranges and found.blocks_read <= found.blocks


def test_search_skips_blocks(spark, texts, tmp_path):
    rare = texts.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit(" zinc"))).otherwise(F.col("text")))
    found = IndexStore(spark, str(tmp_path), **HOW).create(rare, "a").search("zinc reactor", 3)
    assert found.rows.count() == 3
    assert found.blocks_read < found.blocks and found.ranges_read < found.ranges


def links(spark, rows):
    return spark.createDataFrame(rows, "url long, direction string, pos int, link long")


def test_upsert_adds_a_version_and_leaves_readers_alone(spark, tmp_path):
    path = str(tmp_path)
    first = spark.createDataFrame([(1, "red fox"), (2, "the blue fox")], "doc_id long, text string")
    old = IndexStore(spark, path, **HOW).create(first, "X", links(spark, [(1, "in", 0, 7), (1, "in", 1, 7), (1, "in", 2, 8)]))
    more = spark.createDataFrame([(2, "other text"), (3, "green fox fox")], "doc_id long, text string")
    new_links = links(spark, [(1, "in", 0, 9), (1, "in", 1, 8), (1, "in", 2, 9), (3, "out", 0, 1)])
    new = old.upsert(more, "Y", new_links)
    assert (old.number, new.number) == (1, 2)
    assert rows_of(old.documents()) == [(1, "red fox", "X"), (2, "the blue fox", "X")]
    assert rows_of(new.documents()) == [(1, "red fox", "X"), (2, "the blue fox", "X Y"), (3, "green fox fox", "Y")]
    assert rows_of(new.links()) == [(1, "in", 0, 7), (1, "in", 1, 7), (1, "in", 2, 8), (1, "in", 3, 9), (3, "out", 0, 1)]
    again = new.upsert(more, "Y", new_links)
    assert again is new and IndexStore(spark, path, **HOW).number == 2
    assert [r.doc_id for r in old.search("fox", 9).rows.collect()] == [1, 2]
    whole = new.documents().select("doc_id", "text")
    for k in (1, 2, 9):
        want = [(r.doc_id, round(r.score, 9)) for r in search.best(search.bm25_documents(whole, "foxes", **HOW), k).collect()]
        assert [(r.doc_id, round(r.score, 9)) for r in new.search("foxes", k).rows.collect()] == want
        flat = new.compact() if k == 1 else flat
        assert [(r.doc_id, round(r.score, 9)) for r in flat.search("foxes", k).rows.collect()] == want
    assert len(flat.versions) == 1 and flat.number == 3
    assert rows_of(flat.documents()) == rows_of(new.documents()) and rows_of(flat.links()) == rows_of(new.links())
    assert IndexStore(spark, path, number=1, **HOW).number == 1
    assert rows_of(IndexStore(spark, path, number=2, **HOW).documents()) == rows_of(new.documents())


def test_a_delta_without_new_texts(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red fox"), (2, None)], "doc_id long, text string")
    store = IndexStore(spark, str(tmp_path)).create(docs, "X").upsert(docs, "Y")
    assert store.number == 2 and rows_of(store.authors()) == [(1, "X Y"), (2, "X Y")]
    assert [r.doc_id for r in store.search("fox", 5).rows.collect()] == [1]
    assert store.compact().postings().count() == 2
    none = IndexStore(spark, str(tmp_path / "none")).create(docs.filter("false"), "X")
    assert none.search("fox", 5).rows.collect() == [] and none.documents().collect() == []


def test_a_broken_write_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    first = spark.createDataFrame([(1, "red fox")], "doc_id long, text string")
    store = IndexStore(spark, path).create(first, "X")
    more = spark.createDataFrame([(2, "blue fox")], "doc_id long, text string")
    monkeypatch.setattr("linkloom.operators.store.blocked", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.upsert(more, "Y")
    monkeypatch.undo()
    assert rows_of(IndexStore(spark, path).documents()) == [(1, "red fox", "X")]
    assert IndexStore(spark, path).upsert(more, "Y").number == 2
    with pytest.raises(ValueError):
        IndexStore(spark, path).create(first, "X")


def test_postings_move_as_texts_and_finished_blocks(spark, texts):
    from linkloom.operators import store as stores

    made = stores.blocked(stores.range_blocks(texts, 2, 3, **HOW), 2, 2)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 3  # the fixture's own, the documents by range, the blocks by bucket
    entries = F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("lens").alias("doc_len"), F.col("tfs").alias("tf"), "positions")
    got = made.select("term", F.inline(entries)).withColumn("tf", F.col("tf").cast("long"))
    assert rows_of(got) == rows_of(index.postings(texts, **HOW))
    facts = made.filter("n <> size(doc_ids) or max_tf <> array_max(tfs) or min_len <> array_min(lens)")
    assert made.count() == made.select("term", "range").distinct().count() and facts.isEmpty()


def test_compaction_joins_blocks_or_lays_them_out_anew(spark, texts, tmp_path, monkeypatch):
    half = texts.filter("doc_id % 10 < 7")
    flat = IndexStore(spark, str(tmp_path), **HOW).create(half, "a").upsert(texts, "b")
    want = rows_of(index.postings(texts, **HOW))
    for per_range in (128, 1):
        monkeypatch.setattr("linkloom.operators.store.DOCS_PER_RANGE", per_range)
        flat = flat.compact()
        blocks = flat.blocks()
        assert blocks.count() == blocks.select("term", "range").distinct().count()
        got = flat.postings().select("term", "doc_id", "doc_len", F.col("tf").cast("long").alias("tf"), "positions")
        assert rows_of(got) == want
        assert (flat.versions[0].n_docs, flat.versions[0].parts) == (texts.count(), 1 if per_range == 128 else 23)


def test_what_the_store_holds_is_not_broadcast(store):
    assert "Broadcast" not in store.documents()._jdf.queryExecution().executedPlan().toString()


def shown(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_any_ids_are_the_same_after_their_move(spark):
    from linkloom.operators import store as stores

    for kind, ids in (("string", ["a b|,c", "", "7", None]), ("long", [-5, 0, 2 ** 62, None])):
        docs = spark.createDataFrame([(k, "the reactor core core of tower") for k in ids] + [(ids[0], "tower")], f"doc_id {kind}, text string")
        made = stores.range_blocks(docs, 1, 2, **HOW)
        moved = stores.blocked(made, 2, 2)
        rows = lambda df: sorted(map(repr, df.select(*made.columns).collect()))
        assert rows(moved) == rows(made) and moved.select(*made.columns).dtypes == made.dtypes


def test_blocks_move_without_what_follows_from_them(spark, texts):
    from linkloom.operators import store as stores

    moved = stores.blocked(stores.range_blocks(texts, 2, 3, **HOW), 2, 2)
    below = shown(moved).split("Exchange hashpartitioning(bucket", 1)[1].split("\n")[1]
    assert "numbers" in below and not any(f" AS {c}#" in below for c in ("n", "tfs", "lens", "doc_ids", "positions"))


def test_only_texts_of_repeated_ids_are_moved(spark):
    from linkloom.operators.store import one_a_document

    once = spark.createDataFrame([(1, "a"), (2, None), (None, "n")], "doc_id long, text string")
    assert "Exchange" not in shown(one_a_document(once)) and rows_of(one_a_document(once).fillna(0)) == rows_of(once.fillna(0))
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n"), (3, None), (3, None)]
    got = one_a_document(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, once.sparkSession.createDataFrame(sorted(set(rows), key=repr), "doc_id long, text string").collect()))


def test_lengths_of_texts_are_made_before_the_join(store):
    got = store.documents(F.length("text").alias("n_chars"))
    plan = shown(got)
    assert plan.index("Exchange") < plan.index("length(text")
    assert rows_of(got.fillna(-1)) == rows_of(store.documents().select("doc_id", F.length("text").alias("n_chars"), "author").fillna(-1))


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_compaction_moves_only_blocks_that_meet_others(spark, texts, tmp_path, monkeypatch, most):
    monkeypatch.setattr("linkloom.operators.store.MAX_BROADCAST_ROWS", most)
    first = texts.filter("doc_id <> 2002")
    store = IndexStore(spark, str(tmp_path), **HOW).create(first, "a").upsert(texts, "b")
    met, kept = store._meeting()
    if most:
        assert "hashpartitioning" not in shown(kept) and kept.count() + met.count() == store.blocks().count()
        assert met.count() == 1  # the one long document has a range of its own
    else:
        assert kept is None
    flat = store.compact()
    got = flat.postings().select("term", "doc_id", "doc_len", F.col("tf").cast("long").alias("tf"), "positions")
    assert rows_of(got) == rows_of(index.postings(texts, **HOW))
    again = flat.compact()
    assert again.number == 4 and rows_of(again.blocks().drop("version")) == rows_of(flat.blocks().drop("version"))
