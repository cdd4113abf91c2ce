"""The inverted index: positioned terms, postings, term and corpus statistics, and the stored form."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import analyze, is_kept, normalize_token, tokens
from linkloom.operators.linkgraph import hot_join
from linkloom.session import ship_package


# The outer generators below keep Spark from testing the arrays for emptiness before they are
# exploded: that test would be pushed to the scan and cut every text into words a second time.


def raw_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id, pos, token`` for ``doc_id, text``; positions count every word."""
    words = docs.select("doc_id", F.posexplode_outer(tokens(F.col("text"))).alias("pos", "token"))
    return words.filter("token is not null")


def positioned_terms(docs: DataFrame, stop_words: Iterable[str] = (), stop_after_lower: bool = False,
                     stem: bool = False) -> DataFrame:
    """``doc_id, doc_len, pos, token, term``: index terms with the gaps stop words leave in the positions."""
    stop_words = list(stop_words)
    words = docs.select("doc_id", tokens(F.col("text")).alias("words"))
    if stop_words:
        numbered = F.transform("words", lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
        kept = F.filter(numbered, lambda w: is_kept(w.token, stop_words, stop_after_lower))
        words = words.select("doc_id", kept.alias("words"))
        rows = words.select("doc_id", F.size("words").alias("doc_len"), "words").select(
            "doc_id", "doc_len", F.inline_outer("words"))
    else:
        rows = words.select("doc_id", F.size("words").alias("doc_len"), "words").select(
            "doc_id", "doc_len", F.posexplode_outer("words").alias("pos", "token"))
    rows = rows.filter("token is not null").withColumn("term", normalize_token(F.col("token")))
    if stem:
        from linkloom.functions.porter import stem as stem_column

        ship_package(docs.sparkSession)
        rows = rows.withColumn("term", stem_column("term"))
    return rows


def _terms_at(docs: DataFrame, stop_words: Iterable[str] = (), stop_after_lower: bool = False,
              stem: bool = False) -> DataFrame:
    """``doc_id, terms, at``: the index terms of a document in text order, and their positions."""
    stop_words = list(stop_words)
    if stop_words:
        numbered = F.transform(tokens(F.col("text")), lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
        kept = F.filter(numbered, lambda w: is_kept(w.token, stop_words, stop_after_lower))
        words = docs.select("doc_id", kept.alias("kept"))
        words = words.select("doc_id", F.transform("kept", lambda w: normalize_token(w.token)).alias("terms"),
                             F.transform("kept", lambda w: w.pos).alias("at"))
    else:
        words = docs.select("doc_id", analyze(F.col("text")).alias("terms"))
        words = words.withColumn("at", F.transform("terms", lambda t, i: i))
    if stem:
        from linkloom.functions.porter import stem_array

        ship_package(docs.sparkSession)
        words = words.select("doc_id", stem_array("terms").alias("terms"), "at")
    return words


def _places(terms: Column) -> Column:
    return F.sort_array(F.arrays_zip(terms.alias("term"), F.col("at").alias("pos"))).alias("places")


def term_places(docs: DataFrame, **analyzer) -> DataFrame:
    """``doc_id, doc_len, places``: the index terms of a document with their positions, sorted by both, in one array."""
    return _terms_at(docs, **analyzer).select("doc_id", F.size("terms").alias("doc_len"), _places(F.col("terms")))


def packed_terms(docs: DataFrame, **analyzer) -> DataFrame:
    """``doc_id, doc_len, words, at``: the index terms of a document in one text, in which it is moved cheaply.

    No term has a blank in it, so nothing is lost; documents without terms are left out.
    """
    words = _terms_at(docs, **analyzer).select(
        "doc_id", F.size("terms").alias("doc_len"), F.array_join("terms", " ").alias("words"), "at")
    return words.filter("doc_len > 0")


def unpacked_postings(packed: DataFrame, *also: str) -> DataFrame:
    """:func:`postings` of the rows of :func:`packed_terms`, with further columns these have."""
    return _postings(packed.select("doc_id", "doc_len", *also, _places(F.split("words", " "))), *also)


def postings(docs: DataFrame, **analyzer) -> DataFrame:
    """``term, doc_id, doc_len, tf, positions``.

    A document is one row, so its postings are made in that row, from its sorted terms; nothing is shuffled.
    """
    return _postings(term_places(docs, **analyzer))


def _postings(rows: DataFrame, *also: str) -> DataFrame:
    first = F.filter(F.sequence(F.lit(0), F.col("doc_len") - 1), lambda i: (i == 0) | (
        F.get("places", i)["term"] != F.get("places", i - 1)["term"]))
    rows = rows.withColumn("first", F.when(F.col("doc_len") > 0, first).otherwise(F.array().cast("array<int>")))
    ends = F.concat(F.slice("first", F.lit(2), F.col("doc_len")), F.array("doc_len"))
    each = F.filter(F.zip_with("first", ends, lambda s, e: F.struct(
        F.get("places", s)["term"].alias("term"), (e - s).cast("long").alias("tf"),
        F.transform(F.slice("places", s + 1, e - s), lambda p: p["pos"]).alias("positions"))), lambda r: r["term"].isNotNull())
    each = rows.select("doc_id", "doc_len", *also, F.inline_outer(each)).filter("term is not null")
    return each.select("term", "doc_id", "doc_len", "tf", "positions", *also)


def term_counts(docs: DataFrame, **analyzer) -> DataFrame:
    """Postings without positions: ``term, doc_id, doc_len, tf``."""
    return positioned_terms(docs, **analyzer).groupBy("term", "doc_id", "doc_len").agg(F.count("*").alias("tf"))


def term_stats(docs: DataFrame, **analyzer) -> DataFrame:
    """``term, df, cf``: documents with the term and its occurrences.

    Each document sends its words once for ``cf`` and its distinct words once for ``df``; both are
    summed on the map side, so one shuffle of the vocabulary is all there is.
    """
    if analyzer.get("stem"):
        ship_package(docs.sparkSession)
    terms = docs.select(analyze(F.col("text"), **analyzer).alias("terms"))
    sets = F.array(
        F.struct("terms", F.lit(0).alias("d"), F.lit(1).alias("c")),
        F.struct(F.array_distinct("terms").alias("terms"), F.lit(1).alias("d"), F.lit(0).alias("c")))
    return (
        terms.select(F.inline_outer(sets)).select(F.explode_outer("terms").alias("term"), "d", "c")
        .filter("term is not null")
        .groupBy("term")
        .agg(F.sum("d").alias("df"), F.sum("c").alias("cf"))
    )


def vocabulary_stems(docs: DataFrame, **analyzer) -> DataFrame:
    """``term, stem, cf``: every distinct term goes through the stemmer once."""
    from linkloom.functions.porter import stem as stem_column

    ship_package(docs.sparkSession)
    terms = docs.select(F.explode_outer(analyze(F.col("text"), **analyzer)).alias("term"))
    counted = terms.filter("term is not null").groupBy("term").agg(F.count("*").alias("cf"))
    return counted.select("term", stem_column("term").alias("stem"), "cf")


def corpus_stats(docs: DataFrame, **analyzer) -> DataFrame:
    """One row ``n_docs, avg_len``."""
    if analyzer.get("stem"):
        ship_package(docs.sparkSession)
    length = F.size(analyze(F.col("text"), **analyzer))
    return docs.select(length.alias("n")).agg(F.count("*").alias("n_docs"), F.avg("n").alias("avg_len"))


def write_index(docs: DataFrame, path: str, buckets: int = 64, writers_per_bucket: int = 4,
                replace: bool = False, **analyzer) -> None:
    """Store postings by term bucket, with term and corpus statistics beside them.

    ``buckets`` takes the place of index shards. The writers of one bucket share its documents, so
    a term in a third of all documents is written by several tasks. An existing index stays as it
    is unless ``replace`` is set. All tables go to the folder of a new version, and the row that names
    the version is added last: a broken run leaves no trace in what readers see.
    """
    spark = docs.sparkSession
    before = newest_version(spark, path)
    if before is not None and not replace:
        return
    number, name = (before.number + 1 if before else 1), f"version-{uuid.uuid4().hex}"
    folder = f"{path}/{name}"
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(writers_per_bucket)).cast("int")
    rows = postings(docs, **analyzer).withColumn("bucket", bucket)
    (
        rows.repartition(buckets * writers_per_bucket, "bucket", share)
        .sortWithinPartitions("bucket", "term", "doc_id")
        .write.partitionBy("bucket").parquet(f"{folder}/postings")
    )
    stored = spark.read.parquet(f"{folder}/postings")
    (
        stored.groupBy("bucket", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
        .repartition(buckets, "bucket").sortWithinPartitions("bucket", "term")
        .write.partitionBy("bucket").parquet(f"{folder}/terms")
    )
    corpus_stats(docs, **analyzer).write.parquet(f"{folder}/corpus")
    marker = spark.range(1).select(F.lit(number).alias("number"), F.lit(name).alias("name"), F.lit(buckets).alias("buckets"))
    marker.write.mode("append").parquet(f"{path}/versions")


def newest_version(spark: SparkSession, path: str):
    """The row ``number, name, buckets`` of the newest complete version, or nothing."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema("number int, name string, buckets int").parquet(f"{path}/versions").orderBy(
        F.desc("number"), "name").first()


class StoredIndex:
    """The tables of one stored index; reading a term touches only its bucket."""

    def __init__(self, spark: SparkSession, path: str):
        version = newest_version(spark, path)
        if version is None:
            raise FileNotFoundError(f"no complete index under {path}")
        self.spark = spark
        self.path = f"{path}/{version.name}"
        self.buckets = version.buckets

    def _of_terms(self, name: str, terms: list[str]) -> DataFrame:
        wanted = self.spark.range(1).select(
            F.array(*[F.pmod(F.xxhash64(F.lit(t)), F.lit(self.buckets)).cast("int") for t in terms]).alias("b"))
        buckets = wanted.first().b
        table = self.spark.read.parquet(f"{self.path}/{name}")
        return table.filter(F.col("bucket").isin(buckets) & F.col("term").isin(terms))

    def postings(self, terms: list[str]) -> DataFrame:
        return self._of_terms("postings", terms)

    def term_stats(self, terms: list[str]) -> DataFrame:
        return self._of_terms("terms", terms)

    def corpus(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/corpus")


def merge_links(existing: DataFrame, incoming: DataFrame, author: str, refresh_text: bool = False) -> DataFrame:
    """Upsert ``doc_id, text, inlinks, outlinks`` into ``doc_id, text, inlinks, outlinks, author``.

    A new id is inserted. A known id keeps its text and links and gets the links it lacks behind
    them, each once, in their order; the author is added unless the field already contains it.
    """
    old, new = existing.alias("old"), incoming.alias("new")

    def links(name: str):
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        merged = F.concat(before, F.array_except(after, before))
        return F.when(before.isNull(), after).when(after.isNull(), before).otherwise(merged).alias(name)

    had, got = F.col("old.doc_id").isNotNull(), F.col("new.doc_id").isNotNull()
    text = F.coalesce("new.text", "old.text") if refresh_text else F.when(had, F.col("old.text")).otherwise(
        F.col("new.text"))
    held = F.col("old.author")
    signed = (
        F.when(~had, F.lit(author))
        .when(~got | F.contains(held, F.lit(author)), held)
        .otherwise(F.concat_ws(" ", held, F.lit(author)))
    )
    return old.join(new, F.col("old.doc_id") == F.col("new.doc_id"), "full_outer").select(
        F.coalesce("old.doc_id", "new.doc_id").alias("doc_id"), text.alias("text"), links("inlinks"),
        links("outlinks"), signed.alias("author"))


def merge_documents(existing: DataFrame, incoming: DataFrame, author: str) -> DataFrame:
    """The upsert without links: ``doc_id, text, author``; links go through ``merge_link_rows``.

    A known id keeps its text, and the author is added unless the field already contains it.
    """
    old, new = existing.alias("old"), incoming.alias("new")
    had, got, held = F.col("old.doc_id").isNotNull(), F.col("new.doc_id").isNotNull(), F.col("old.author")
    signed = (
        F.when(~had, F.lit(author)).when(~got | F.contains(held, F.lit(author)), held)
        .otherwise(F.concat_ws(" ", held, F.lit(author))))
    return old.join(new, F.col("old.doc_id") == F.col("new.doc_id"), "full_outer").select(
        F.coalesce("old.doc_id", "new.doc_id").alias("doc_id"),
        F.when(had, F.col("old.text")).otherwise(F.col("new.text")).alias("text"), signed.alias("author"))


def document_links(docs: DataFrame, rows: DataFrame, redirects: DataFrame) -> DataFrame:
    """``doc_id, direction, link``: the links of a document's own URL or, where it has none, of its redirect partner.

    ``rows`` are ``url, direction, link`` as :func:`link_rows` makes them, so a hub is many rows and never one list.
    """
    known = rows.select(F.col("url").alias("doc_id")).distinct().withColumn("known", F.lit(True))
    partner = redirects.select(F.col("url").alias("doc_id"), "other_url")
    placed = docs.select("doc_id").join(known, "doc_id", "left").join(partner, "doc_id", "left")
    url = F.when(F.col("known"), F.col("doc_id")).otherwise(F.col("other_url"))
    places = placed.select("doc_id", url.alias("url")).distinct()
    return hot_join(rows, places, ["url"], "link", "inner").select("doc_id", "direction", "link")


def with_link_info(docs: DataFrame, links: DataFrame, redirects: DataFrame) -> DataFrame:
    """Documents with ``inlinks, outlinks`` of their own URL or, failing that, of its redirect partner.

    ``links`` has ``url, inlinks, outlinks`` with one row per URL, ``redirects`` has ``url, other_url``.
    Documents found in neither are dropped.
    """
    info = F.struct("inlinks", "outlinks")
    own = links.select(F.col("url").alias("doc_id"), info.alias("own"))
    partner = redirects.join(links.select(F.col("url").alias("other_url"), info.alias("other")), "other_url").select(
        F.col("url").alias("doc_id"), "other")
    found = F.coalesce("own", "other")
    return (
        docs.join(own, "doc_id", "left").join(partner, "doc_id", "left")
        .withColumn("found", found).filter(F.col("found").isNotNull())
        .select(*docs.columns, "found.inlinks", "found.outlinks")
    )
