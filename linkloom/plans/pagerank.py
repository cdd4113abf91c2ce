"""PageRank as a loop of joins and sums over an edge table laid out once."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.scores import truncate
from linkloom.operators.linkgraph import clean_edges, edge_ends
from linkloom.session import checkpoint, hub_block_for, partitions_for, steady_plans

DAMPING = 0.85
HUB_BLOCK = 1_000_000
STABLE_ROUNDS = 4


@dataclass
class Layout:
    """A graph ready for rounds: ``vertices`` by id, and ``edges`` by source or a rule in their place."""

    vertices: DataFrame  # id, out_degree, blocks
    n: int
    has_sinks: bool
    width: int
    edges: DataFrame | None = None  # src, dsts, and part when hubs are split
    next_id: Column | None = None  # the one target of an id, when there is no edge table

    def send(self, ranks: DataFrame) -> DataFrame:
        """``dst, share`` for every link: each source's rank over its out-degree."""
        sources = ranks.filter("out_degree > 0")
        share = (F.col("rank") / F.col("out_degree")).alias("share")
        if self.edges is None:
            return sources.select(self.next_id.alias("dst"), share)
        keys = [c for c in self.edges.columns if c != "dsts"]
        shares = sources.select(F.col("id").alias("src"), share, *(
            [F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part")] if "part" in keys else []))
        # both sides are partitioned and sorted by the keys
        return self.edges.hint("merge").join(shares, keys).select(F.explode("dsts").alias("dst"), "share")


def lay_out(edges: DataFrame, vertices: DataFrame | None = None, uncrawled: str = "leak",
            dedupe: bool = True, hub_block: int = HUB_BLOCK) -> Layout:
    """Partition vertices by id and the lists of links by source, once for all rounds.

    ``vertices`` names the crawled pages; links from elsewhere are dropped. Links to elsewhere keep
    their part of the source's rank (``leak``) or are taken out first (``drop``). The links of a
    page with more than ``hub_block`` of them are split by destination into blocks, each its own
    join key, and the page's share is sent once per block. There are at most links / hub_block such
    pages, and the block grows with the links, so their table is always small enough to broadcast.
    Without ``dedupe`` the edges are taken as they are, distinct and cheap to read again.
    """
    spark = edges.sparkSession
    edges = clean_edges(edges) if dedupe else edges.select("src", "dst")
    if vertices is not None:
        vertices = vertices.select("id").distinct()
        edges = edges.join(vertices.withColumnRenamed("id", "src"), "src", "left_semi")
        if uncrawled == "drop":
            edges = edges.join(vertices.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")
    if dedupe or vertices is not None:
        edges = checkpoint(edges)
    links = edges.count()
    width = partitions_for(spark, links)
    hub_block = hub_block_for(links, hub_block)
    with steady_plans(spark, width):
        ends = edge_ends(edges)
        if vertices is not None:
            listed = vertices.select("id", F.lit(0).alias("n_out"), F.lit(True).alias("listed"))
            ends = ends.select("id", "n_out", F.lit(False).alias("listed")).unionByName(listed)
            nodes = ends.groupBy("id").agg(F.sum("n_out").alias("out_degree"), F.max("listed").alias("listed"))
            nodes = nodes.filter("listed").drop("listed")
        else:
            nodes = ends.groupBy("id").agg(F.sum("n_out").alias("out_degree"))
        blocks = F.greatest(F.ceil(F.col("out_degree") / F.lit(hub_block)), F.lit(1)).cast("int")
        nodes = nodes.withColumn("blocks", blocks)
        nodes = checkpoint(nodes.repartition(width, "id").sortWithinPartitions("id"))
        facts = nodes.agg(F.count("*").alias("n"), F.count_if(F.col("out_degree") == 0).alias("sinks"),
                          F.count_if(F.col("blocks") > 1).alias("hubs")).first()
        if facts.hubs == 0:
            table = edges.repartition(width, "src").groupBy("src")
        else:
            hubs = F.broadcast(nodes.filter("blocks > 1").select(F.col("id").alias("src"), "blocks"))
            part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("blocks")), F.lit(0)).cast("int")
            split = edges.join(hubs, "src", "left").select("src", part.alias("part"), "dst")
            table = split.repartition(width, "src", "part").groupBy("src", "part")
        # a round reads and joins one row for the links of a source, or of a block of a hub's
        table = table.agg(F.collect_list("dst").alias("dsts"))
        table = checkpoint(table.sortWithinPartitions(*[c for c in table.columns if c != "dsts"]))
    return Layout(nodes, facts.n, facts.sinks > 0, width, edges=table)


def lay_out_chain(nodes: DataFrame, k: int) -> Layout:
    """The chain graph without an edge table: ``i`` points to ``i + 1``, every ``k``-th id and the last to nothing.

    The next id is a projection, so a round costs the one shuffle of its sum.
    """
    spark = nodes.sparkSession
    n, last = nodes.agg(F.count("*"), F.max("id")).first()
    end = (F.col("id") % F.lit(k) == 0) | (F.col("id") == F.lit(last))
    width = partitions_for(spark, n)
    with steady_plans(spark, width):
        rows = nodes.select("id", F.when(end, 0).otherwise(1).alias("out_degree"), F.lit(1).alias("blocks"))
        rows = checkpoint(rows.repartition(width, "id").sortWithinPartitions("id"))
    return Layout(rows, n, True, width, next_id=F.col("id") + 1)


def start_ranks(layout: Layout) -> DataFrame:
    return layout.vertices.withColumn("rank", F.lit(1.0 / max(layout.n, 1)))


def next_ranks(layout: Layout, ranks: DataFrame, damping: float = DAMPING,
               mass_precision: float | None = None) -> DataFrame:
    """One update; ``ranks`` must be cheap to read, its sink mass is summed beside the join."""
    got = layout.send(ranks).groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("got"))
    mass: Column = F.lit(0.0)
    if layout.has_sinks:
        mass = ranks.agg(F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("rank"))), F.lit(0.0))).scalar()
        if mass_precision:
            mass = truncate(mass, mass_precision)
    n = max(layout.n, 1)
    base = F.lit((1 - damping) / n) + F.lit(damping) * mass / F.lit(n)
    return layout.vertices.join(got, "id", "left").select(
        "id", "out_degree", "blocks", (base + F.lit(damping) * F.coalesce("got", F.lit(0.0))).alias("rank"))


def fixed_rounds(layout: Layout, rounds: int, damping: float = DAMPING,
                 mass_precision: float | None = None, rounds_per_write: int = 5) -> DataFrame:
    """``id, rank`` after exactly ``rounds`` updates.

    With sinks a round is read twice, for its shares and its sink mass, so each is written. Without
    sinks several rounds form one job.
    """
    ranks = start_ranks(layout)
    every = 1 if layout.has_sinks else rounds_per_write
    with steady_plans(layout.vertices.sparkSession, layout.width):
        for i in range(1, rounds + 1):
            ranks = next_ranks(layout, ranks, damping, mass_precision)
            if i % every == 0 or i == rounds:
                ranks = checkpoint(ranks)
    return ranks.select("id", "rank")


def rank_histogram(ranks: DataFrame, places: int = 12, value: str = "rank") -> DataFrame:
    """``value, n``: how many vertices share a score, compared at ``places`` decimals."""
    return ranks.groupBy(F.round(value, places).alias("value")).agg(F.count("*").alias("n"))


def perplexity(ranks: DataFrame, places: int = 12, value: str = "rank") -> DataFrame:
    """One row ``perplexity``: two to the summed p·log2 p over the score histogram."""
    counts = rank_histogram(ranks, places, value)
    return counts.agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted")).select(
        F.pow(F.lit(2.0), F.col("weighted") / F.col("total") - F.log2("total")).alias("perplexity"))


def is_stable(history: list[float]) -> bool:
    """The last four perplexities, at six decimals, are one and the same."""
    tail = history[-STABLE_ROUNDS:]
    return len(tail) == STABLE_ROUNDS and len(set(tail)) == 1


def until_converged(layout: Layout, stop: str = "tol", tol: float = 1e-9, max_rounds: int | None = None,
                    damping: float = DAMPING, check_every: int = 5) -> tuple[DataFrame, int]:
    """``id, rank`` and the number of updates made.

    ``tol`` stops when the summed change of all ranks in one update, looked at every ``check_every``
    updates, is below ``tol``; ``histogram`` stops when the perplexity of the score histogram was the
    same four times. Only that scalar reaches the driver. Reaching ``max_rounds`` first is warned of.
    """
    ranks = start_ranks(layout)
    history: list[float] = []
    with steady_plans(layout.vertices.sparkSession, layout.width):
        for done in count():
            if stop == "histogram":
                history.append(round(perplexity(ranks).first().perplexity, 6))
                if is_stable(history):
                    break
            if done == max_rounds:
                warnings.warn(f"PageRank did not meet its stop {stop!r} in {done} rounds", stacklevel=2)
                break
            after = next_ranks(layout, ranks, damping)
            if stop != "tol" or (done + 1) % check_every:
                ranks = checkpoint(after)
                continue
            before = ranks.select("id", F.col("rank").alias("before"))
            ranks = checkpoint(after.join(before, "id").withColumn("moved", F.abs(F.col("rank") - F.col("before"))))
            if ranks.agg(F.sum("moved")).first()[0] < tol:
                done += 1
                break
            ranks = ranks.drop("moved", "before")
    return ranks.select("id", "rank"), done


def rank_report(ranks: DataFrame, edges: DataFrame, n: int = 500) -> DataFrame:
    """The ``n`` best pages: ``page, rank, score, n_in, n_out``; equal scores go by page.

    The cut comes first, so degrees are counted only for the ``n`` pages, which are few enough to
    send to every task.
    """
    top = checkpoint(ranks.orderBy(F.desc(F.round("rank", 9)), "id").limit(n).select("id", F.col("rank").alias("score")))
    few = F.broadcast(top.select("id"))
    near = edges.join(few.withColumnRenamed("id", "src"), "src", "left_semi").select("src", "dst").union(
        edges.join(few.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")).distinct()
    counts = edge_ends(near).join(few, "id", "left_semi").groupBy("id").agg(
        F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
    placed = top.agg(F.sort_array(F.collect_list(F.struct((-F.round("score", 9)).alias("neg"), "id", "score"))).alias("a"))
    numbered = placed.select(F.posexplode("a").alias("at", "row")).select(
        F.col("row.id").alias("id"), (F.col("at") + 1).alias("rank"), "row.score")
    return numbered.join(counts, "id", "left").select(
        F.col("id").alias("page"), "rank", "score", F.coalesce("n_in", F.lit(0)).alias("n_in"),
        F.coalesce("n_out", F.lit(0)).alias("n_out"))


def chain_nodes(spark, k: int) -> DataFrame:
    """The ``k * k`` nodes of the generated chain graph."""
    return spark.range(1, k * k + 1)


def chain_edges(nodes: DataFrame, k: int) -> DataFrame:
    """``src, dst`` of the chain; the end of each row of ``k``, and the last node, point to the dummy node 0."""
    last = nodes.agg(F.max("id")).scalar()
    return nodes.select(F.col("id").alias("src"), F.when((F.col("id") % k == 0) | (F.col("id") == last), 0).otherwise(F.col("id") + 1).alias("dst"))


def chain_table(nodes: DataFrame, k: int) -> DataFrame:
    """``id, adjacency, rank`` of the chain, as its generator writes it to rank lines."""
    return chain_edges(nodes, k).select(
        F.col("src").alias("id"), F.array("dst").alias("adjacency"), F.lit(1.0 / (k * k)).alias("rank"))


def with_dummy(ranks: DataFrame) -> DataFrame:
    """The ranks and the dummy node 0, which keeps nothing."""
    dummy = ranks.sparkSession.range(1).select(F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("rank"))
    return ranks.select("id", "rank").unionByName(dummy)
