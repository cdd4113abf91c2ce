"""The focused crawl as waves of table jobs over captured pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.markup import BOILERPLATE
from linkloom.functions.urls import canonicalize
from linkloom.operators.frontier import BATCH_STEP, SHARES, admit, score_frontier, take_batch
from linkloom.operators.linkgraph import inlink_count
from linkloom.operators.pages import is_valid_response, page_anchors, page_links, page_title, parse_pages
from linkloom.session import MAX_BROADCAST_ROWS, checkpoint
from linkloom.sources.growing import GrowingTable
from linkloom.sources.pagestore import PageStore
from linkloom.sources.state import load_state, save_state


@dataclass
class CrawlRules:
    """What a crawl is told: boilerplate, link scope, relevance, URLs to ignore, batch growth and limits."""

    boilerplate: Sequence[str] = tuple(BOILERPLATE)
    nested: str = "once"
    scope: str = "content"
    relevance: dict | None = field(default_factory=dict)  # None keeps every link
    score_terms: dict = field(default_factory=dict)
    ignore: Sequence[str] = ()
    batch_step: int | None = BATCH_STEP  # None hands out the whole frontier
    capacity: int | None = None  # entries the frontier holds at most
    required: int | None = None  # pages after which the crawl ends


METRICS = "iteration int, items long, share_items long, pages long, fetched long, frontier long"


@dataclass
class CrawlState:
    """Tables between two waves. Those that only grow are kept in ``logs``, in few parts after any number of waves."""

    frontier: DataFrame  # level, url
    logs: dict[str, GrowingTable]
    inlinks: GrowingTable  # url, n_inlinks: what each wave added to the counts
    fetched: int = 0
    iteration: int = 0
    handed_out: int = BATCH_STEP  # size of the next batch
    docs: DataFrame | None = None  # doc_id, title, text of the last wave
    metrics: tuple = ()
    saved: int = -1  # the last wave whose rows are on disk

    GROWING = ("completed", "seen", "visited", "edges", "scores")

    @property
    def completed(self) -> DataFrame:
        """``url``, handed out."""
        return self.logs["completed"].rows()

    @property
    def seen(self) -> DataFrame:
        """``url``, ever queued."""
        return self.logs["seen"].rows()

    @property
    def visited(self) -> DataFrame:
        """``url``, fetched."""
        return self.logs["visited"].rows()

    @property
    def edges(self) -> DataFrame:
        """``src, dst``"""
        return self.logs["edges"].rows()

    @property
    def scores(self) -> DataFrame:
        """``url, wave, score, inlink_score``"""
        return self.logs["scores"].rows()

    def grown(self, **added: DataFrame) -> dict:
        """The growing tables with the written rows of the next wave, and the in-link counts with those of its links."""
        wave = self.iteration + 1
        logs = {name: self.logs[name].add(rows, wave, written=True) for name, rows in added.items()}
        return {"logs": logs, "inlinks": self.inlinks.add(inlink_count(added["edges"]), wave)}

    def save(self, path: str) -> CrawlState:
        """Write the frontier, the metrics and the rows not yet saved, then the one marker that makes the wave count."""
        if self.saved == self.iteration:
            return self
        # the folders are named by iteration, so the column needs another name
        metrics = metrics_table(self.frontier.sparkSession, self).filter(F.col("iteration") >= self.saved)
        metrics = metrics.withColumnRenamed("iteration", "number")
        new = {name: self.logs[name].rows(after=self.saved) for name in self.GROWING}
        save_state({"frontier": self.frontier}, {**new, "metrics": metrics}, path, self.iteration,
                   fetched=self.fetched, handed_out=self.handed_out)
        return replace(self, saved=self.iteration)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CrawlState | None:
        """The state as of the last wave with a marker; in-link counts come from its edges, once."""
        saved = load_state(spark, path)
        if saved is None:
            return None
        tables, numbers = saved
        wave = numbers["iteration"]
        # one row per wave
        metrics = [tuple(row) for row in tables["metrics"].orderBy("number").collect()] if "metrics" in tables else []
        return cls(frontier=tables["frontier"], logs={n: GrowingTable().add(tables[n], wave, written=True) for n in cls.GROWING},
                   inlinks=GrowingTable(key="url", total="n_inlinks").add(inlink_count(tables["edges"]), wave),
                   metrics=tuple(metrics), saved=wave, **numbers)


def start(seeds: DataFrame, rules: CrawlRules | None = None) -> CrawlState:
    """Seeds ``url`` become the first level."""
    spark = seeds.sparkSession
    urls = checkpoint(seeds.select(canonicalize(F.col("url"), F.col("url")).alias("url")).filter("url != ''").distinct())
    none = spark.range(0)
    text = F.lit("").alias
    first = {
        "completed": none.select(text("url")), "seen": urls, "visited": none.select(text("url")),
        "edges": none.select(text("src"), text("dst")),
        "scores": none.select(text("url"), F.lit(1).alias("wave"), F.lit(0.0).alias("score"),
                              F.lit(0.0).alias("inlink_score"))}
    counts = GrowingTable(key="url", total="n_inlinks").add(inlink_count(first["edges"]), 0)
    return CrawlState(frontier=urls.select(F.lit(1).alias("level"), "url"), inlinks=counts,
                      logs={name: GrowingTable().add(rows, 0) for name, rows in first.items()},
                      handed_out=(rules or CrawlRules()).batch_step or 0)


def captured(pages: DataFrame) -> DataFrame:
    """Captured pages under their canonical URL; responses that are no HTML pages are left out.

    ``capture`` orders several captures of one URL, of which the first is read: the page's id where there is one.
    """
    if {"status", "headers"} <= set(pages.columns):
        pages = pages.filter(is_valid_response(F.col("status"), F.col("headers")))
    capture = F.col("page_id") if "page_id" in pages.columns else F.sha2("html", 256)
    return pages.select(canonicalize(F.col("url"), F.col("url")).alias("url"), capture.alias("capture"), "html")


def crawl_wave(state: CrawlState, pages: DataFrame | PageStore, rules: CrawlRules) -> CrawlState:
    """Hand out one batch, read its pages, and queue the links they lead to.

    From a :class:`PageStore` a wave reads only the buckets of its batch; a plain table is scanned.
    """
    waiting = state.frontier.count()
    size = waiting if rules.batch_step is None else min(waiting, state.handed_out)
    batch = checkpoint(state.frontier if size == waiting else take_batch(state.frontier, size))
    todo = batch.join(state.completed, "url", "left_anti")
    if rules.ignore:
        todo = todo.filter(~F.col("url").isin(list(rules.ignore)))
    keys = batch.select("url").distinct()
    keys = F.broadcast(keys) if size <= MAX_BROADCAST_ROWS else keys
    scored = score_frontier(todo, state.inlinks.sums_of(keys), **rules.score_terms)
    wanted = checkpoint(scored.withColumnRenamed("link", "url").join(state.visited, "url", "left_anti"))
    if isinstance(pages, PageStore):
        page = pages.lookup(wanted)
    else:
        # a batch of bounded size goes to the pages, so that only the pages it names are moved
        wanted = F.broadcast(wanted) if size <= MAX_BROADCAST_ROWS else wanted
        found = wanted.join(pages, "url")
        first = found.groupBy("url").agg(F.min("capture").alias("capture"))
        page = found.join(first, ["url", "capture"]).dropDuplicates(["url"])
    read = checkpoint(
        parse_pages(page, rules.boilerplate, rules.nested)
        .select("url", "wave", "score", "inlink_score", page_title(F.col("html")).alias("title"), "markup"))
    anchors = page_anchors(read.withColumn("page_id", F.col("url")), rules.scope)
    links = checkpoint(page_links(anchors, rules.ignore, rules.relevance).select(
        F.col("page_id").alias("src"), F.col("link").alias("dst")))
    levels = read.select(F.col("url").alias("src"), (F.col("wave") + 1).alias("level"))
    found = links.join(levels, "src").groupBy(F.col("dst").alias("url")).agg(F.min("level").alias("level"))
    found = checkpoint(found.join(state.seen, "url", "left_anti").select("level", "url"))
    rest = state.frontier.join(batch.select("url"), "url", "left_anti").select("level", "url")
    found = checkpoint(admit(waiting - size, found, rules.capacity)) if rules.capacity is not None else found
    frontier = checkpoint(rest.unionByName(found))
    n_read = read.count()
    share = -(-size // SHARES) if size >= SHARES else size
    row = (state.iteration, size, share, n_read, state.fetched + n_read, frontier.count())
    grows = rules.batch_step is not None and waiting > state.handed_out
    return replace(
        state, frontier=frontier,
        **state.grown(completed=batch.select("url"), seen=found.select("url"), visited=read.select("url"), edges=links,
                      scores=read.select("url", "wave", "score", "inlink_score")),
        fetched=state.fetched + n_read, iteration=state.iteration + 1,
        handed_out=state.handed_out + (rules.batch_step if grows else 0),
        docs=read.select(F.col("url").alias("doc_id"), "title", F.array_join("markup.blocks", "\n").alias("text")),
        metrics=state.metrics + (row,))


def crawl(state: CrawlState, pages: DataFrame | PageStore, rules: CrawlRules | None = None, max_waves: int | None = None,
          docs_path: str | None = None, state_path: str | None = None) -> CrawlState:
    """Waves until the frontier is empty, enough pages are read, or ``max_waves`` are done.

    ``pages`` come from :func:`captured`, as they are or in a :class:`PageStore`. With paths, each wave writes its documents to a folder of its own,
    which a repeated wave overwrites, and saves the state, from which :meth:`CrawlState.load` resumes.
    """
    rules = rules or CrawlRules()
    done = 0
    while (rules.required is None or state.fetched <= rules.required) and (max_waves is None or done < max_waves):
        if state.frontier.isEmpty():
            break
        state = write_wave(crawl_wave(state, pages, rules), docs_path, state_path)
        done += 1
    return state


def write_wave(state: CrawlState, docs_path: str | None = None, state_path: str | None = None) -> CrawlState:
    """Write what the last wave made: its documents, then the state with its marker."""
    if docs_path:
        state.docs.write.mode("overwrite").parquet(f"{docs_path}/iteration={state.iteration}")
    return state.save(state_path) if state_path else state


def committed_docs(spark: SparkSession, docs_path: str, state_path: str) -> DataFrame | None:
    """``doc_id, title, text`` of the waves up to the last whose state was saved, or nothing before the first.

    Documents of a wave that was cut short are not read, though its folder may be there.
    """
    saved = load_state(spark, state_path)
    if saved is None:
        return None
    docs = spark.read.parquet(docs_path)
    return docs.filter(F.col("iteration") <= saved[1]["iteration"]).drop("iteration")


def metrics_table(spark: SparkSession, state: CrawlState) -> DataFrame:
    """One row per wave: ``iteration, items, share_items, pages, fetched, frontier``."""
    return spark.createDataFrame(list(state.metrics), METRICS)
