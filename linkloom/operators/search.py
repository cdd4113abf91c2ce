"""Ranked search: BM25 over raw documents or a stored index, result pages, highlighting, fused ranking."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import TOKEN_PATTERN, WORD_CHAR, analyze
from linkloom.operators.index import StoredIndex
from linkloom.session import checkpoint, ship_package

K1, B = 1.2, 0.75
MARK_OPEN, MARK_CLOSE, INNER_STOP = "\u0001", "\u0002", "\u0003"


def query_terms(spark: SparkSession, query: str, **analyzer) -> Counter:
    """The query's index terms and how often each is asked for."""
    if analyzer.get("stem"):
        ship_package(spark)
    return Counter(spark.range(1).select(analyze(F.lit(query), **analyzer).alias("t")).first().t)


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, doc_len: Column, avg_len: Column, k1: float = K1, b: float = B) -> Column:
    return tf / (tf + k1 * (1 - b + b * doc_len / avg_len))


def bm25_documents(docs: DataFrame, query: str, k1: float = K1, b: float = B, **analyzer) -> DataFrame:
    """``doc_id, score`` of every document with a query term.

    The texts are read once: what remains is a narrow table of lengths and term counts, from which
    both the statistics and the scores come. No text is shuffled.
    """
    spark = docs.sparkSession
    wanted = query_terms(spark, query, **analyzer)
    if not wanted:
        return docs.select("doc_id", F.lit(0.0).alias("score")).filter(F.lit(False))
    terms = docs.select("doc_id", analyze(F.col("text"), **analyzer).alias("terms"))
    counts = [F.size("terms") - F.size(F.array_remove("terms", F.lit(t))) for t in wanted]
    table = checkpoint(
        terms.select("doc_id", F.size("terms").alias("doc_len"),
                     *[c.alias(f"tf{i}") for i, c in enumerate(counts)]))
    stats = table.agg(
        F.struct(
            F.count("*").alias("n_docs"), F.avg("doc_len").alias("avg_len"),
            *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(wanted))],
        ).alias("stats")
    ).scalar()
    hits = table.filter(reduce(lambda x, y: x | y, [F.col(f"tf{i}") > 0 for i in range(len(wanted))]))
    hits = hits.withColumn("stats", stats)
    parts = [
        F.lit(weight) * idf(F.col("stats.n_docs"), F.col(f"stats.df{i}"))
        * saturation(F.col(f"tf{i}"), F.col("doc_len"), F.col("stats.avg_len"), k1, b)
        for i, weight in enumerate(wanted.values())
    ]
    return hits.select("doc_id", reduce(add, parts).alias("score"))


def bm25_index(index: StoredIndex, query: str, k1: float = K1, b: float = B, **analyzer) -> DataFrame:
    """The same scores from a stored index; only the buckets of the query's terms are read."""
    wanted = query_terms(index.spark, query, **analyzer)
    terms = list(wanted)
    corpus = index.corpus().select(F.struct("n_docs", "avg_len").alias("c")).scalar()
    weight = F.element_at(F.create_map(*[F.lit(x) for kv in wanted.items() for x in kv]), F.col("term")) \
        if terms else F.lit(0)
    # at most one row of statistics per query term
    stats = F.broadcast(index.term_stats(terms).select("term", "df", weight.alias("weight")))
    rows = index.postings(terms).select("term", "doc_id", "doc_len", "tf").join(stats, "term").withColumn("c", corpus)
    part = F.col("weight") * idf(F.col("c.n_docs"), F.col("df")) * saturation(
        F.col("tf"), F.col("doc_len"), F.col("c.avg_len"), k1, b)
    return rows.groupBy("doc_id").agg(F.sum(part).alias("score"))


def best(scored: DataFrame, n: int, key: str = "doc_id", offset: int = 0) -> DataFrame:
    """The ``n`` highest scores after ``offset`` rows with their ``rank``; equal scores go by ``key``."""
    top = scored.orderBy(F.desc(F.round("score", 9)), key).offset(offset).limit(n)
    # the window sees no more than the n rows of the limit
    rows = top.agg(F.sort_array(F.collect_list(F.struct(
        (-F.round("score", 9)).alias("neg"), F.col(key), "score"))).alias("rows"))
    return rows.select(F.posexplode("rows").alias("at", "row")).select(
        (F.col("at") + offset + 1).alias("rank"), f"row.{key}", "row.score")


def root_set(docs: DataFrame, query: str, n: int = 1000, **analyzer) -> DataFrame:
    """``id`` of the ``n`` best documents for a query, the start of a HITS neighbourhood."""
    return best(bm25_documents(docs, query, **analyzer), n).select(F.col("doc_id").alias("id"))


def highlight(text: Column, terms: list[str], fragments: int | None = 5, escape: bool = True, stem: bool = False) -> Column:
    """Sentences with a query term, the term wrapped in ``<em>``, joined by an ellipsis; the first ``fragments`` or all.

    Sentences are cut before words are marked, and a full stop inside a word ends none. A word is marked when the analyzer makes a query term of it, whatever its case or accents.
    """
    words = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
    pairs = F.arrays_zip(words.alias("word"), analyze(text, stem=stem).alias("term"))
    shown = F.array_distinct(F.transform(F.filter(pairs, lambda p: p.term.isin(terms)), lambda p: p.word))
    quoted = F.transform(shown, lambda w: F.replace(w, F.lit("."), F.lit("\\.")))
    pattern = F.concat(
        F.lit(f"(?<!{WORD_CHAR})(?<!{WORD_CHAR}['’.])("), F.array_join(quoted, "|"),
        F.lit(f")(?!{WORD_CHAR}|['’.]{WORD_CHAR})"))
    whole = F.regexp_replace(text, rf"(?<={WORD_CHAR})\.(?={WORD_CHAR})", INNER_STOP)
    sentences = F.regexp_extract_all(whole, F.lit(r"[^.!?\n]+[.!?]*"), F.lit(0))
    # the pattern is made once for a text, not once for a sentence
    marked = F.element_at(F.transform(F.array(pattern), lambda p: F.transform(sentences, lambda s: F.regexp_replace(
        F.replace(s, F.lit(INNER_STOP), F.lit(".")), p, F.lit(f"{MARK_OPEN}$1{MARK_CLOSE}")))), 1)
    chosen = F.filter(marked, lambda s: F.contains(s, F.lit(MARK_OPEN)))
    chosen = chosen if fragments is None else F.slice(chosen, 1, fragments)
    shown_text = F.array_join(F.transform(chosen, lambda s: F.trim(s)), " … ")
    if escape:
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            shown_text = F.replace(shown_text, F.lit(sign), F.lit(name))
    shown_text = F.replace(shown_text, F.lit(MARK_OPEN), F.lit("<em>"))
    shown_text = F.replace(shown_text, F.lit(MARK_CLOSE), F.lit("</em>"))
    return F.when(F.size(shown) > 0, shown_text).otherwise(F.lit(""))


def search_page(docs: DataFrame, query: str, page: int = 1, size: int = 10, legacy_offset: bool = False,
                scored: DataFrame | None = None, fragments: int = 5, **analyzer) -> DataFrame:
    """One result page: ``rank, doc_id, title, author, score, total, fragments``.

    ``docs`` has ``doc_id, text, title, author``. Page ``p`` starts after ``(p - 1) * size`` rows;
    ``legacy_offset`` starts it after ``p - 1`` rows instead. ``scored`` may bring scores from a
    stored index; without it the documents themselves are scored.
    """
    spark = docs.sparkSession
    if scored is None:
        scored = bm25_documents(docs, query, **analyzer)
    scored = checkpoint(scored)
    offset = page - 1 if legacy_offset else (page - 1) * size
    # written first: its size is then known, and the optimizer chooses how to bring the page to the texts
    hits = checkpoint(best(scored, size, offset=offset).withColumn("total", scored.agg(F.count("*")).scalar()))
    terms = list(query_terms(spark, query, **analyzer))
    return hits.join(docs, "doc_id").select(
        "rank", "doc_id",
        F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("doc_id").cast("string")).alias("title"),
        "author", "score", "total",
        highlight(F.col("text"), terms, fragments, stem=analyzer.get("stem", False)).alias("fragments"))


def top_terms(stats: DataFrame, n: int = 20) -> DataFrame:
    """``term, df, cf`` of the terms found in most documents, from term statistics."""
    return stats.select("term", "df", "cf").orderBy(F.desc("df"), "term").limit(n)


def topical_score(docs: DataFrame, term_weights: dict[str, float], **analyzer) -> DataFrame:
    """``doc_id, score``: summed weights of the topical terms a document contains, per occurrence."""
    found = docs.select("doc_id", F.filter(
        analyze(F.col("text"), **analyzer), lambda t: t.isin(list(term_weights))).alias("terms"))
    counts = [F.size("terms") - F.size(F.array_remove("terms", F.lit(t))) for t in term_weights]
    score = reduce(add, [F.lit(float(w)) * c for w, c in zip(term_weights.values(), counts)])
    return found.filter(F.size("terms") > 0).select("doc_id", score.alias("score"))


def combine_scores(ids: DataFrame, parts: list[tuple[DataFrame, float]]) -> DataFrame:
    """``doc_id, score``: weighted sum of score tables, each scaled by its largest score."""
    total = F.lit(0.0)
    out = ids.select("doc_id")
    for i, (scores, weight) in enumerate(parts):
        scores = checkpoint(scores)
        largest = scores.agg(F.max("score")).scalar()
        scaled = scores.select("doc_id", (F.col("score") / F.nullif(largest, F.lit(0.0))).alias(f"s{i}"))
        out = out.join(scaled, "doc_id", "left")
        total = total + F.lit(weight) * F.coalesce(f"s{i}", F.lit(0.0))
    return out.select("doc_id", total.alias("score"))
