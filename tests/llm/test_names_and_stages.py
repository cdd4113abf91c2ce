"""Tables whose columns have the names that operators use inside, and every pipeline stage against a plain version."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import chat, extract, rules, simhash, suffix, toxicity
from linkloom.llm.common import table

NAMES = ("n_words", "Failed", "kept", "_row", "row", "_hash", "_id", "_data", "_spans", "key", "_key", "toxicity", "fp", "spans",
         "component_id", "text_hash", "_words", "_text", "h")
WORDS = [a + b for a in "bad kel mor tis nu pa".split() for b in "do ra lin ve s tor".split()]


def text_of(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with one column for each helper name; a value names its row and column."""
    passage = text_of(9, 30)
    texts = [text_of(k, 60 + k) for k in range(8)] + [text_of(3, 63) + " extra", text_of(2, 62), passage + " " + text_of(20, 50),
                                                      text_of(21, 70) + " " + passage, "few words", None, "", "# | # | " * 30]
    rows = [(k, t, "en", "s", len(t or ""), *[f"{k}-{n}" for n in NAMES]) for k, t in enumerate(texts)]
    rows.append(rows[5])
    fields = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    table(spark, "/root/testdata/sf0.001", "documents")  # ships the package
    return spark.createDataFrame(rows, fields).repartition(3)


def unharmed(out, docs):
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[n] == f"{r['doc_id']}-{n}" for r in rows for n in NAMES)
    return rows


def test_ledger_takes_the_place_of_its_names(odd):
    rows = rules.apply_policy(rules.ledger(odd)).collect()
    assert len(rows) == odd.count()
    assert all(isinstance(r["n_words"], int) and isinstance(r["kept"], bool) and r["_row"] == f"{r['doc_id']}-_row" for r in rows)


def test_quality_stage(spark, odd):
    kept = Counter(r["doc_id"] for r in unharmed(corpus_pipeline.drop_low_quality(spark, odd, ""), odd))

    def good(text):
        words = (text or "").split()
        windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        seen = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
        mean = sum(map(len, words)) / len(words) if words else 0
        return (len(words) >= 10 and 5 * len(covered) <= len(words) and 10 * len(re.findall(r"[#*$%&|<>]", text)) <= len(words)
                and 2 <= mean <= 20 and 4 * sum(c.isupper() for c in text) <= sum(map(len, words)))

    assert kept == Counter(r["doc_id"] for r in odd.collect() if good(r["text"]))


def test_near_duplicate_stage(spark, odd):
    kept = [r["doc_id"] for r in unharmed(corpus_pipeline.drop_near_duplicates(spark, odd, ""), odd)]
    prints = {}
    for r in odd.collect():
        prints[r["doc_id"]] = int.from_bytes(simhash.fingerprint((r["text"] or "").encode()), "big")
    group = {i: i for i in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS:
                    group[a] = group[b] = min(group[a], group[b])
    assert sorted(kept) == sorted(set(group.values())) and len(kept) < len(prints)


def test_suffix_stage(spark, odd):
    out = corpus_pipeline.cut_repeated_passages(spark, odd, "")
    got = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in unharmed(out, odd))
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    first = {}
    for i, t in rows:
        for p in range(len(t) - 49):
            first[t[p:p + 50]] = min(first.get(t[p:p + 50], i), i)
    want = Counter()
    for i, t in rows:  # the texts are ASCII
        gone = {p + k for p in range(len(t) - 49) if first[t[p:p + 50]] < i for k in range(50)}
        kept = "".join(c for k, c in enumerate(t) if k not in gone)
        want[i, kept, len(kept)] += 1
    assert got == want and any(len(k[1]) < len(t) for k, (_, t) in zip(sorted(want), sorted(set(rows))))


def test_toxicity_stage(spark, folder, odd, monkeypatch):
    net = toxicity.train([text_of(k, 30) + (" vile" * (k % 2)) for k in range(500)], [k % 2 for k in range(500)])
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: net)
    toxic = odd.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" vile vile"))).otherwise(F.col("text")))
    rows = unharmed(corpus_pipeline.drop_toxic(spark, toxic, folder), odd)
    scores = toxicity.scored(toxic.select("doc_id", "text"), net).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in scores if r["score"] < toxicity.THRESHOLD)
    assert 0 < len(rows) < len(scores)


def test_packing_stage(spark, odd):
    rows = corpus_pipeline.pack_sequences(spark, odd, "").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) == 1 or sum(ends.values()) > 2048 * (len(ends) - 1) * 0.5


def test_simhash_and_suffix_keep_to_their_columns(odd):
    assert simhash.near_duplicates(odd).count() == odd.count()
    assert suffix.removals(odd).count() == odd.count()


def test_extract_and_chat_ignore_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>One two.</p>", "x", 3)], "page_id long, url string, html string, text string, n_chars int")
    assert extract.main_text(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert extract.main_text(pages.filter("false")).collect() == []
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversations(chat.turns_to_tree(turns)).collect() == []
