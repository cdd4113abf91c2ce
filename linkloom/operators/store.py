"""A stored index in versions: a base and the deltas after it, merged when read, with postings in blocks for top-k search.

A version is a folder of tables and one row of the manifest, which is written last: what has no row is not seen, and a
reader keeps the versions it was opened with. An upsert adds a delta that holds only what is new, since a known document
keeps its text; :meth:`IndexStore.compact` writes base and deltas as a new base beside them.

Postings stand in blocks: one row for a term and a range of documents. A range holds documents of nearly equal length,
as many as its share of them, so the most a block can add to a score follows from its highest term frequency and its
shortest document. A search adds these bounds up over its terms for each range, scores the most promising ranges, and
reads of the others only those whose bound reaches the score it then has: the result is exact.

Documents move to the task of their range as one text of their terms; their postings are made there, so what is moved by
term are finished blocks, the numbers of each in one text. Texts are moved only where an id comes twice, and a compaction
moves only those blocks of the base that it joins with others.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.index import packed_terms, unpacked_postings
from linkloom.operators.linkgraph import new_link_rows
from linkloom.operators.search import B, K1, best, query_terms, saturation
from linkloom.session import MAX_BROADCAST_ROWS, checkpoint
from linkloom.sources.tables import spread

MANIFEST = "number int, name string, base int, buckets int, parts int, n_docs long, n_words long"
BLOCKS = ("term string, range long, n int, max_tf int, min_len int, cf long, doc_ids array<{kind}>, tfs array<int>, "
          "lens array<int>, positions array<array<int>>, bucket int")
LINKS = "url, direction, pos, link"
DOCS_PER_RANGE = 128
LENGTH_STEPS = 4  # classes of length for each doubling
LENGTH_CLASSES = 16 * LENGTH_STEPS  # about as many as there are in use
CHARS_PER_BUCKET = 300_000_000
CHARS_PER_TASK = 10_000_000  # of texts whose postings one task makes
WRITERS = 16  # of a bucket at most
CODEC = "zstd"  # of all files
FIRST_RANGES, MORE_RANGES = 8, 4


@dataclass
class Found:
    """The rows of a search and how many ranges and blocks it had and read."""

    rows: DataFrame  # rank, doc_id, score
    ranges: int = 0
    ranges_read: int = 0
    blocks: int = 0
    blocks_read: int = 0


def document_range(parts: int) -> Column:
    """The range of a document: its class of length, and within the class one of ``parts`` by its id."""
    length = F.floor(F.log2(F.col("doc_len") + 1) * LENGTH_STEPS)
    return length * parts + F.pmod(F.xxhash64("doc_id"), F.lit(parts))


def range_blocks(docs: DataFrame, parts: int, tasks: int, **analyzer) -> DataFrame:
    """Blocks of the postings of ``docs``, made where the documents of a range meet."""
    packed = packed_terms(docs, **analyzer).withColumn("range", document_range(parts)).repartition(tasks, "range")
    rows = unpacked_postings(packed, "range")
    entry = F.struct("doc_id", F.col("tf").cast("int").alias("tf"), "doc_len", "positions")
    # dealt by range, which the groups contain: no second shuffle
    return _columns(rows.groupBy("term", "range").agg(
        F.count("*").cast("int").alias("n"), F.max("tf").cast("int").alias("max_tf"), F.min("doc_len").alias("min_len"),
        F.sum("tf").alias("cf"), F.sort_array(F.collect_list(entry)).alias("entries")), "doc_len")


def joined_blocks(blocks: DataFrame) -> DataFrame:
    """The rows of :func:`blocked` with one block for a term and range, made where these meet."""
    lists, place = ("doc_ids", "tfs", "lens", "positions"), ("bucket", "writer")
    met = blocks.groupBy(*place, "term", "range").agg(
        F.sum("n").cast("int").alias("n"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"),
        F.sum("cf").alias("cf"), *[F.flatten(F.collect_list(c)).alias(c) for c in lists])
    names = ("doc_id", "tf", "len", "positions")
    entries = F.sort_array(F.arrays_zip(*[F.col(c).alias(n) for c, n in zip(lists, names)])).alias("entries")
    return _columns(met.select(*place, "term", "range", "n", "max_tf", "min_len", "cf", entries), "len", *place)


def _columns(rows: DataFrame, length: str, *also: str) -> DataFrame:
    return rows.select(
        "term", "range", "n", "max_tf", "min_len", "cf", F.col("entries.doc_id").alias("doc_ids"),
        F.col("entries.tf").alias("tfs"), F.col(f"entries.{length}").alias("lens"), F.col("entries.positions").alias("positions"), *also)


def _joined(numbers: Column) -> Column:
    return F.array_join(numbers.cast("array<string>"), " ", "")


def _parted(text: Column, kind: str) -> Column:
    return F.transform(F.split(text, " "), lambda x: F.nullif(x, F.lit("")).cast(kind))


def blocked(rows: DataFrame, buckets: int, writers: int) -> DataFrame:
    """Blocks dealt to their buckets. The writers of a bucket share its ranges, so a frequent term is no single task's work.

    A block moves as its term, its range and one text of its numbers; the other columns follow from these. Ids that are
    not whole numbers move as they are.
    """
    kind = rows.schema["doc_ids"].dataType.elementType.simpleString()
    whole = kind in ("bigint", "int", "smallint", "tinyint")
    ids = [] if whole else ["doc_ids"]
    numbers = [_joined(F.col("doc_ids"))] if whole else []
    numbers += [_joined(F.col("lens")), F.array_join(F.transform("positions", _joined), ",")]
    moved = rows.select("term", "range", *ids, F.concat_ws("|", *numbers).alias("numbers"),
                        F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"),
                        F.pmod(F.xxhash64("range"), F.lit(writers)).cast("int").alias("writer"))
    moved = moved.repartition(buckets * writers, "bucket", "writer").withColumn("numbers", F.split("numbers", "[|]"))
    part = [F.get("numbers", F.lit(i)) for i in range(len(numbers))]
    positions = F.transform(F.split(part[-1], ","), lambda p: F.split(p, " ").cast("array<int>"))
    moved = moved.select("term", "range", "bucket", "writer", (_parted(part[0], kind) if whole else F.col("doc_ids")).alias("doc_ids"),
                         F.split(part[-2], " ").cast("array<int>").alias("lens"), positions.alias("positions"))
    moved = moved.withColumn("tfs", F.transform("positions", F.size))
    return moved.select(
        "term", "range", F.size("doc_ids").alias("n"), F.array_max("tfs").alias("max_tf"), F.array_min("lens").alias("min_len"),
        F.aggregate("tfs", F.lit(0).cast("long"), lambda x, y: x + y).alias("cf"), "doc_ids", "tfs", "lens", "positions", "bucket", "writer")


def one_a_document(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with one row an id; only the texts of ids that come again are moved."""
    docs = docs.select("doc_id", "text")
    again = checkpoint(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("again")))
    n = again.count()
    if n == 0:
        return docs
    if n > MAX_BROADCAST_ROWS:
        return docs.dropDuplicates(["doc_id"])
    few, same = F.broadcast(again), F.col("doc_id").eqNullSafe(F.col("again"))
    return docs.join(few, same, "left_anti").unionByName(docs.join(few, same, "left_semi").dropDuplicates(["doc_id"]))


class IndexStore:
    """The versions of one store that a reader sees. ``analyzer`` must be the same for all calls."""

    def __init__(self, spark: SparkSession, path: str, number: int | None = None, **analyzer):
        self.spark, self.path, self.analyzer = spark, path, analyzer
        self.versions = self._versions(number)

    def _versions(self, number: int | None) -> list:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return []
        # one row a version; of two writers of one number the first by name counts
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").orderBy("number", "name").collect()
        seen = {}
        for row in rows:
            if number is None or row.number <= number:
                seen.setdefault(row.number, row)
        if not seen:
            return []
        newest = seen[max(seen)]
        return [row for n, row in sorted(seen.items()) if n >= newest.base]

    @property
    def number(self) -> int:
        return self.versions[-1].number if self.versions else 0

    def _table(self, name: str, schema: str | None = None, versions: list | None = None) -> DataFrame:
        read = self.spark.read.schema(schema) if schema else self.spark.read
        tables = [read.parquet(f"{self.path}/{v.name}/{name}").withColumn("version", F.lit(v.number))
                  for v in versions or self.versions]
        return reduce(DataFrame.unionByName, tables)

    def _id_kind(self) -> str:
        texts = self.spark.read.parquet(f"{self.path}/{self.versions[0].name}/texts")
        return texts.schema["doc_id"].dataType.simpleString()

    def texts(self) -> DataFrame:
        """``doc_id, text`` of all documents."""
        return self._table("texts").drop("version")

    def authors(self) -> DataFrame:
        """``doc_id, author`` as of the newest version."""
        return self._table("authors").groupBy("doc_id").agg(F.max_by("author", "version").alias("author"))

    def links(self) -> DataFrame:
        """``url, direction, pos, link`` of all documents."""
        return self._table("links").drop("version")

    def documents(self, text: Column | None = None) -> DataFrame:
        """``doc_id, text, author``; ``text`` is what to take in place of the text, which then is not moved."""
        texts = self.texts() if text is None else self.texts().select("doc_id", text)
        return texts.join(self.authors().hint("merge"), "doc_id")

    def blocks(self, terms: list[str] | None = None) -> DataFrame:
        """Blocks of all terms or of some; for some only their buckets are read."""
        schema = BLOCKS.format(kind=self._id_kind())  # a delta may have none
        if terms is None:
            return self._table("blocks", schema)
        buckets = self.versions[0].buckets
        chosen = self.spark.range(1).select(F.array(*[
            F.pmod(F.xxhash64(F.lit(t)), F.lit(buckets)).cast("int") for t in terms]).alias("b")).first().b if terms else []
        return self._table("blocks", schema).filter(F.col("bucket").isin(chosen) & F.col("term").isin(terms))

    def postings(self, terms: list[str] | None = None) -> DataFrame:
        """``term, doc_id, doc_len, tf, positions``."""
        entries = F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("lens").alias("doc_len"), F.col("tfs").alias("tf"),
                               F.col("positions").alias("positions"))
        return self.blocks(terms).select("term", F.inline(entries))

    def _commit(self, texts: DataFrame, authors: DataFrame, links: DataFrame, base: bool, layout: tuple[int, int] | None = None,
                blocks: tuple[DataFrame, DataFrame] | None = None) -> IndexStore:
        """The version of these tables. The blocks are made from the texts, once these are written, unless they are given,
        as those to join and those that stay in their bucket as they are; ``layout`` are the numbers of buckets and of
        parts where the size of the texts does not tell them."""
        number, name = self.number + 1, f"version-{uuid.uuid4().hex}"
        folder = f"{self.path}/{name}"

        def write(rows: DataFrame, table: str, *by: str) -> None:
            rows.write.option("compression", CODEC).partitionBy(*by).parquet(f"{folder}/{table}")

        write(texts, "texts")
        write(authors, "authors")
        write(links, "links")
        docs = self.spark.read.schema(texts.schema).parquet(f"{folder}/texts")
        n_docs, n_chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
        buckets, parts = layout or self._layout(n_docs, n_chars)
        tasks = max(1, -(-n_chars // CHARS_PER_TASK))
        made, kept = blocks or (range_blocks(spread(docs), parts, tasks, **self.analyzer), None)
        dealt = blocked(made, buckets, min(WRITERS, -(-tasks // buckets)))
        rows = (joined_blocks(dealt) if blocks else dealt).drop("writer")
        write(rows if kept is None else rows.unionByName(kept), "blocks", "bucket")
        kind = texts.schema["doc_id"].dataType.simpleString()
        written = self.spark.read.schema(BLOCKS.format(kind=kind)).parquet(f"{folder}/blocks")
        n_words = written.agg(F.sum("cf")).first()[0] or 0
        row = (number, name, number if base else self.versions[0].number, buckets, parts, n_docs, n_words)
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return IndexStore(self.spark, self.path, **self.analyzer)

    def create(self, docs: DataFrame, author: str, links: DataFrame | None = None) -> IndexStore:
        """The base: ``docs`` have ``doc_id, text``, ``links`` are rows ``url, direction, pos, link``."""
        if self.versions:
            raise ValueError(f"there is an index under {self.path}")
        docs = one_a_document(docs)
        links = self._no_links(docs) if links is None else links.selectExpr(*LINKS.split(", "))
        return self._commit(docs, docs.select("doc_id", F.lit(author).alias("author")), links, True)

    @classmethod
    def _layout(cls, n_docs: int, n_chars: int) -> tuple[int, int]:
        return max(1, -(-n_chars // CHARS_PER_BUCKET)), cls._parts(n_docs)

    @staticmethod
    def _parts(n_docs: int) -> int:
        return max(1, n_docs // (DOCS_PER_RANGE * LENGTH_CLASSES))

    def _no_links(self, docs: DataFrame) -> DataFrame:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return self.spark.createDataFrame([], f"url {kind}, direction string, pos int, link {kind}")

    def upsert(self, docs: DataFrame, author: str, links: DataFrame | None = None) -> IndexStore:
        """A delta with the documents, links and authors that the store lacks; without any, the store as it is.

        A known document keeps its text and its links and gets the links it lacks behind them; the author is added
        unless the field already contains it.
        """
        docs = docs.select("doc_id", "text").dropDuplicates(["doc_id"])
        # never broadcast: Spark would guess the size of what the store holds from that of its files
        held = self.authors().hint("merge")
        new = checkpoint(docs.join(held.select("doc_id"), "doc_id", "left_anti"))
        signed = docs.select("doc_id").join(held, "doc_id", "left")
        lacks = F.col("author").isNull() | ~F.contains("author", F.lit(author))
        authors = checkpoint(signed.filter(lacks).select("doc_id", F.concat_ws(" ", "author", F.lit(author)).alias("author")))
        more = checkpoint(self._no_links(docs) if links is None else new_link_rows(self.links(), links))
        if new.isEmpty() and authors.isEmpty() and more.isEmpty():
            return self
        base = self.versions[0]
        return self._commit(new, authors, more, False, (base.buckets, base.parts))

    def compact(self) -> IndexStore:
        """Base and deltas as one new base; readers of the old versions go on with them.

        Blocks of one term and range are joined; those of the base that meet none of a delta are copied where they
        stand. Where the documents have become twice as many as their layout is for, or more, they are laid out anew from
        their texts.
        """
        texts, base = self.texts(), self.versions[0]
        if self._parts(sum(v.n_docs for v in self.versions)) >= 2 * base.parts:
            return self._commit(texts, self.authors(), self.links(), True)
        return self._commit(texts, self.authors(), self.links(), True, (base.buckets, base.parts), self._meeting())

    def _meeting(self) -> tuple[DataFrame, DataFrame | None]:
        """The blocks of the deltas with those of the base that they meet, and the others of the base."""
        schema, key = BLOCKS.format(kind=self._id_kind()), ["term", "range"]
        blocks = self._table("blocks", schema).drop("version")
        if len(self.versions) == 1:
            return blocks.filter("false"), blocks
        base, added = (self._table("blocks", schema, v).drop("version") for v in (self.versions[:1], self.versions[1:]))
        met = checkpoint(added.select(*key).distinct())
        if met.count() > MAX_BROADCAST_ROWS:
            return blocks, None
        return base.join(F.broadcast(met), key, "left_semi").unionByName(added), base.join(F.broadcast(met), key, "left_anti")

    def search(self, query: str, k: int, k1: float = K1, b: float = B) -> Found:
        """The ``k`` documents with the highest BM25 scores, as :func:`search.best` orders them."""
        wanted = query_terms(self.spark, query, **self.analyzer)
        n_docs, n_words = (sum(v[c] for v in self.versions) for c in ("n_docs", "n_words"))
        bounds = self.blocks(list(wanted)).select("version", "term", "range", "n", "max_tf", "min_len")
        df = {r.term: r.df for r in bounds.groupBy("term").agg(F.sum("n").alias("df")).collect()}  # one row a term
        if not df:
            return Found(self.spark.createDataFrame([], f"rank int, doc_id {self._id_kind()}, score double"))
        avg_len = F.lit(n_words / n_docs)
        weights = {t: wanted[t] * math.log(1 + (n_docs - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        weight = F.element_at(F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]), F.col("term"))
        most = weight * saturation(F.col("max_tf"), F.col("min_len"), avg_len, k1, b)
        ranges = checkpoint(bounds.groupBy("version", "range").agg(F.sum(most).alias("most"), F.count("*").alias("blocks")))
        total, n_blocks = ranges.agg(F.count("*"), F.sum("blocks")).first()

        def scored(chosen: DataFrame) -> DataFrame:
            entries = F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("lens").alias("doc_len"), F.col("tfs").alias("tf"))
            rows = self.blocks(list(weights)).select("version", "range", "term", "doc_ids", "lens", "tfs").join(
                chosen.select("version", "range"), ["version", "range"])
            part = weight * saturation(F.col("tf"), F.col("doc_len"), avg_len, k1, b)
            return rows.select("term", F.inline(entries)).groupBy("doc_id").agg(F.sum(part).alias("score"))

        first = FIRST_RANGES
        while True:
            chosen = checkpoint(ranges.orderBy(F.desc("most"), "version", "range").limit(first))
            known = checkpoint(best(scored(chosen), k))
            if first >= total or known.count() == k:
                break
            first *= MORE_RANGES
        least = known.agg(F.min("score")).first()[0] if known.count() == k else -math.inf
        # scores are compared at nine places
        rest = checkpoint(ranges.join(chosen.select("version", "range"), ["version", "range"], "left_anti").filter(
            F.col("most") >= least - 1e-8))
        n_rest, rest_blocks = rest.agg(F.count("*"), F.coalesce(F.sum("blocks"), F.lit(0))).first()
        rows = best(known.select("doc_id", "score").unionByName(scored(rest)), k)
        first_blocks = chosen.agg(F.sum("blocks")).first()[0]
        return Found(rows, total, chosen.count() + n_rest, n_blocks, first_blocks + rest_blocks)
