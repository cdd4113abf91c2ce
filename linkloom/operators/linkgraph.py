"""The link graph as an edge table ``src, dst``: vertices, degrees, sinks, adjacency, redirects."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import checkpoint

LIST_BLOCK = 100_000
SALTS = 16
HOT_ROWS = 100_000  # rows of one join key that a task takes


def salted(df: DataFrame, column: str) -> DataFrame:
    """Rows with a ``salt`` drawn from another column, which spreads a hot join key."""
    return df.withColumn("salt", F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int"))


def on_every_salt(df: DataFrame) -> DataFrame:
    """The other side of such a join: each row once for every salt."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def clean_edges(edges: DataFrame) -> DataFrame:
    """Each link once. The shuffle goes by the whole pair, so a hub is spread over its links."""
    return edges.select("src", "dst").dropDuplicates()


def edges_by_source(edges: DataFrame) -> DataFrame:
    """Each link once, dealt by ranges of the whole pair: the links of a URL lie together, those of a hub in several ranges.

    What is then grouped by ``src`` moves a row for each URL and range it lies in, however many partitions there are.
    After :func:`clean_edges` the links of a URL are everywhere, and it moves nearly a row for each link. But there a link
    that comes very often is made one before it moves; here all its rows go to one range, whose task holds it once.
    """
    return edges.select("src", "dst").repartitionByRange("src", "dst").dropDuplicates()


def edge_ends(edges: DataFrame) -> DataFrame:
    """``id, n_out, n_in`` with one row per end of an edge, for one-pass sums over both directions."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("n_out"), F.lit(0).alias("n_in")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("n_out"), F.lit(1).alias("n_in")),
    )
    return edges.select(F.inline(ends))


def graph_vertices(edges: DataFrame) -> DataFrame:
    """Every id that occurs at either end."""
    return edge_ends(edges).select("id").distinct()


def degrees(edges: DataFrame, distinct: bool = True) -> DataFrame:
    """``id, in_degree, out_degree``, of distinct links unless told otherwise."""
    edges = clean_edges(edges) if distinct else edges
    return edge_ends(edges).groupBy("id").agg(F.sum("n_in").alias("in_degree"), F.sum("n_out").alias("out_degree"))


def inlink_count(edges: DataFrame) -> DataFrame:
    """``url, n_inlinks``; a repeated link counts every time."""
    return edges.groupBy(F.col("dst").alias("url")).agg(F.count("*").alias("n_inlinks"))


def sink_vertices(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Vertices without an outgoing link."""
    if vertices is not None:
        return vertices.select("id").join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
    return edge_ends(edges).groupBy("id").agg(F.sum("n_out").alias("n")).filter("n = 0").select("id")


def sink_mass(ranks: DataFrame, sinks: DataFrame) -> DataFrame:
    """One row ``mass``: what the sinks hold."""
    return ranks.join(sinks.select("id"), "id", "left_semi").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("mass"))


def link_rows(edges: DataFrame) -> DataFrame:
    """``url, direction, link``: every link seen from both of its ends."""
    ends = F.array(
        F.struct(F.col("src").alias("url"), F.lit("out").alias("direction"), F.col("dst").alias("link")),
        F.struct(F.col("dst").alias("url"), F.lit("in").alias("direction"), F.col("src").alias("link")),
    )
    return edges.select(F.inline(ends))


def link_adjacency(edges: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """``url, block, inlinks, outlinks`` with sorted lists.

    A URL with more than ``block`` links has several rows, each with the links that hash to it, so
    no task and no row ever holds all the links of a hub. All others have the one row of block 0.
    The key is (``url``, ``block``); what needs all links of a URL sums over its blocks or takes :func:`link_rows`.
    """
    rows = link_rows(edges)
    hubs = rows.groupBy("url").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks")).filter("blocks > 1")
    number = F.coalesce(F.pmod(F.xxhash64("link"), F.col("blocks")), F.lit(0)).cast("int")
    rows = salted(rows, "link").join(on_every_salt(checkpoint(hubs)), ["url", "salt"], "left").withColumn("block", number)
    return rows.groupBy("url", "block").agg(
        F.sort_array(F.collect_list(F.when(F.col("direction") == "in", F.col("link")))).alias("inlinks"),
        F.sort_array(F.collect_list(F.when(F.col("direction") == "out", F.col("link")))).alias("outlinks"))


def adjacency_edges(adjacency: DataFrame) -> DataFrame:
    """Back from lists to edges; the outlinks alone hold every edge."""
    return adjacency.select(F.col("url").alias("src"), F.explode("outlinks").alias("dst"))


def new_link_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The rows ``url, direction, pos, link`` that an upsert adds: each unknown link once, at the place of its first
    occurrence behind the highest known position of its list. A list that meets its end is spread over several keys.
    """
    known = existing.select("url", "direction", "link").distinct().hint("merge")
    fresh = incoming.join(known, ["url", "direction", "link"], "left_anti")
    fresh = checkpoint(fresh.groupBy("url", "direction", "link").agg(F.min("pos").alias("pos")))
    ends = existing.groupBy("url", "direction").agg((F.max("pos") + 1).alias("after"))
    moved = hot_join(fresh, ends, ["url", "direction"], "link")
    return moved.select("url", "direction", (F.col("pos") + F.coalesce("after", F.lit(0))).alias("pos"), "link")


def merge_link_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The list upsert on rows ``url, direction, pos, link``, for link lists too long for one row.

    Rows known before stay, and :func:`new_link_rows` follow.
    """
    return existing.select("url", "direction", "pos", "link").unionByName(new_link_rows(existing, incoming))


def resolve_redirects(edges: DataFrame, redirects: DataFrame) -> DataFrame:
    """Edges whose ends are the final URLs; ``redirects`` has ``url, final_url``, one row per URL."""
    edges = checkpoint(edges.select("src", "dst"))

    def rename(df: DataFrame, end: str, other: str) -> DataFrame:
        names = redirects.select(F.col("url").alias(end), F.col("final_url").alias("final"))
        named = hot_join(df, names, [end], other, hot=hot_keys(edges, [end]))
        return named.withColumn(end, F.coalesce("final", end)).drop("final")

    return rename(rename(edges, "src", "dst"), "dst", "src").select("src", "dst")


def redirect_closure(redirects: DataFrame) -> DataFrame:
    """``url, final_url, hops`` from single steps ``url, next_url``: where each chain of redirects ends.

    Pointers are doubled: after a round every URL points twice as far, so a chain of n steps takes log n rounds. A chain
    that runs into a cycle ends at the cycle's smallest URL, and its ``hops`` are null. A URL with several steps takes
    the smallest; a null step, and one to the URL itself, is none.

    A URL knows the smallest URL on the way to where it points. Met twice, that one lies on a cycle, all round which the
    way has been. A URL whose end is known is not looked up again, and one that points to it has its end with it.
    """
    steps = redirects.groupBy("url").agg(F.min("next_url").alias("to")).filter("to <> url")
    turning = checkpoint(steps.select("url", "to", F.lit(1).cast("long").alias("hops"), F.least("url", "to").alias("least"),
                                      F.lit(False).alias("twice")))
    ended = []
    known, joint = F.col("then_final").isNotNull(), F.col("to")
    met_twice = F.when(F.col("least") < F.col("then_least"), F.col("twice")).when(
        F.col("then_least") < F.col("least"), F.col("then_twice")).otherwise(
        F.col("twice") | F.col("then_twice") | (F.col("least") != joint))
    while True:
        names = ["to", "then", "then_hops", "then_least", "then_twice"]
        ahead = turning.select("url", "to", "hops", "least", "twice").toDF(*names).withColumn(
            "then_final", F.lit(None).cast(turning.schema["url"].dataType))
        for part in ended:
            ahead = ahead.unionByName(part.select(
                F.col("url").alias("to"), F.col("hops").alias("then_hops"), F.col("final_url").alias("then_final")),
                allowMissingColumns=True)
        met = hot_join(turning, ahead.withColumn("met", F.lit(True)), ["to"], "url").withColumn(
            "twice", F.coalesce(F.when(F.col("met") & ~known, met_twice), F.lit(False)))
        least = F.least("least", F.coalesce("then_least", "least"))
        final = F.when(F.col("met").isNull(), joint).when(known, F.col("then_final")).when(F.col("twice"), least)
        hops = F.when(F.col("met").isNull(), F.col("hops")).when(~F.col("twice"), F.col("hops") + F.col("then_hops"))
        now = checkpoint(met.select("url", F.coalesce("then", "to").alias("to"), hops.alias("hops"), least.alias("least"),
                                    "twice", final.alias("final_url")))
        ended.append(now.filter("final_url is not null").select("url", "final_url", "hops"))
        turning = now.filter("final_url is null").drop("final_url")
        if turning.isEmpty():
            return reduce(DataFrame.union, ended)


def hot_keys(rows: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """``keys, pieces``: the keys with more than ``most`` rows, by default ``HOT_ROWS``, and into how many pieces these go; written once.

    There are at most rows / most of them, few enough to broadcast.
    """
    counted = rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(most or HOT_ROWS)).cast("int").alias("pieces"))
    return checkpoint(counted.filter("pieces > 1"))


def hot_join(rows: DataFrame, table: DataFrame, keys: list[str], other: str, how: str = "left",
             hot: DataFrame | None = None) -> DataFrame:
    """A join by ``keys`` in which rows of a hot key are spread by ``other``, and the table's rows of such a key, and no
    others, are repeated for each piece. The table is never broadcast: Spark would guess its size from that of its file.

    ``rows`` should be cheap to read, for its keys are counted first unless ``hot`` tells them.
    """
    hot = hot_keys(rows, keys) if hot is None else hot
    if hot.isEmpty():
        return rows.join(table.hint("merge"), keys, how)
    few = F.broadcast(hot.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("pieces").alias("_pieces")))

    def in_pieces(df: DataFrame) -> DataFrame:
        return df.join(few, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left").drop(
            *[f"_{k}" for k in keys])

    piece = F.coalesce(F.pmod(F.xxhash64(other), F.col("_pieces")), F.lit(0)).cast("int")
    spread = in_pieces(rows).withColumn("_piece", piece).drop("_pieces")
    pieces = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    repeated = in_pieces(table).withColumn("_piece", F.explode(pieces)).drop("_pieces")
    return spread.join(repeated.hint("merge"), [*keys, "_piece"], how).drop("_piece")


def write_back_scores(vertices: DataFrame, scores: DataFrame, redirects: DataFrame) -> DataFrame:
    """Put ``wave, score, inlink_score`` of fetched URLs on the graph entry of the URL or its redirect partner.

    ``vertices`` has ``id``, ``scores`` has ``url`` and the three fields, ``redirects`` has ``url, other_url``.
    """
    known = vertices.select(F.col("id").alias("url"), F.lit(True).alias("known"))
    target = F.when(F.col("known"), F.col("url")).otherwise(F.col("other_url"))
    placed = (
        scores.join(known, "url", "left").join(redirects, "url", "left")
        .select(target.alias("id"), "wave", "score", "inlink_score")
        .groupBy("id").agg(F.max_by(F.struct("wave", "score", "inlink_score"), "wave").alias("s"))
    )
    return vertices.select("id").join(placed, "id", "left").select("id", "s.wave", "s.score", "s.inlink_score")
