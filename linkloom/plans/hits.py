"""HITS: base-set growth around a root set, and the hub and authority rounds on the subgraph between its pages."""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.plans.pagerank import HUB_BLOCK, is_stable, perplexity
from linkloom.session import MAX_BROADCAST_ROWS, checkpoint, hub_block_for, partitions_for, steady_plans

ROUNDS_PER_WRITE = 5
SPANNING_STEPS = 16  # of two rounds each
NOISE = 1e-5  # a vector divided by what it was measured as, and then that short, is rounding
ROUNDING = 4 * np.finfo(float).eps  # of a score in a round
SCORES = ("hub", "authority")


def _reach(edges: DataFrame, pages: DataFrame, n_pages: int, near: str, far: str) -> DataFrame:
    """``id``: distinct far ends of the edges whose near end is one of ``pages``."""
    side = pages.select(F.col("id").alias(near))
    side = F.broadcast(side) if n_pages <= MAX_BROADCAST_ROWS else side
    return edges.join(side, near, "left_semi").select(F.col(far).alias("id")).distinct()


def base_set(edges: DataFrame, root: DataFrame, vertices: DataFrame | None = None, target: int | None = None,
             sample: int | None = None, seed: str = "", max_rounds: int | None = None) -> DataFrame:
    """``id``: the root set grown until nothing is left to add, or it has ``target`` pages.

    A round adds every crawled page the set points to, then the crawled pages that point to the
    set: all of them, or at most ``sample``, drawn by the hash of id and seed. ``vertices`` names the crawled pages; without it every id of an edge counts.
    """
    edges = edges.select("src", "dst")
    if vertices is not None:
        known = vertices.select("id").distinct()
        edges = edges.join(known.withColumnRenamed("id", "src"), "src", "left_semi")
        edges = edges.join(known.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")
    pages = checkpoint(root.select("id").distinct())
    size, rounds = pages.count(), 0
    while (target is None or size < target) and (max_rounds is None or rounds < max_rounds):
        pages = checkpoint(pages.union(_reach(edges, pages, size, "src", "dst")).distinct())
        wider = pages.count()
        pointing = _reach(edges, pages, wider, "dst", "src").join(pages, "id", "left_anti")
        if sample is not None:
            pointing = pointing.orderBy(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"))), "id").limit(sample)
        pages = checkpoint(pages.union(pointing))
        before, size, rounds = size, pages.count(), rounds + 1
        if size == before:
            break
    return pages


def subgraph(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """Edges with both ends in ``pages``; a set of few pages goes to the edges, not the edges to the set."""
    ids = checkpoint(pages.select("id").distinct())
    few = ids.count() <= MAX_BROADCAST_ROWS
    for end in ("src", "dst"):
        side = ids.withColumnRenamed("id", end)
        edges = edges.join(F.broadcast(side) if few else side, end, "left_semi")
    return edges.select("src", "dst")


def _scale(raw: DataFrame, name: str, normalize: str) -> Column:
    """The divisor of one score as a scalar: its sum of squares or the root of that."""
    total = raw.agg(F.sum(F.col(name) * F.col(name))).scalar()
    return F.nullif(F.sqrt(total) if normalize == "l2" else total, F.lit(0.0))


def _normalized(raw: DataFrame, normalize: str) -> DataFrame:
    hub, authority = _scale(raw, "hub", normalize), _scale(raw, "authority", normalize)
    return raw.select("id", "blocks", F.coalesce(F.col("hub") / hub, F.lit(0.0)).alias("hub"),
                      F.coalesce(F.col("authority") / authority, F.lit(0.0)).alias("authority"))


def _updated(scores: DataFrame, table: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """One round, not yet scaled: each page gets the sums over the other ends of its links, beside the columns of ``nodes``."""
    sent = scores if keys == ["id"] else scores.withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = table.hint("merge").join(sent.drop("blocks"), keys).select(
        F.explode("others").alias("id"), F.when(~F.col("outward"), F.col("authority")).alias("authority"),
        F.when(F.col("outward"), F.col("hub")).alias("hub"))
    got = met.groupBy("id").agg(F.sum("authority").alias("new_hub"), F.sum("hub").alias("new_authority"))
    return nodes.join(got, "id", "left").select(
        *nodes.columns, F.coalesce("new_hub", F.lit(0.0)).alias("hub"),
        F.coalesce("new_authority", F.lit(0.0)).alias("authority"))


def _from_zero(score: Column) -> Column:
    return F.when(score > 0, score).otherwise(0.0)


def _weights(gram: np.ndarray, image: np.ndarray) -> tuple[float, np.ndarray]:
    """The largest factor by which two rounds stretch a combination of some vectors, and that combination, at length one.

    ``gram`` has the products of the vectors with each other, ``image`` those with what two rounds make of them.
    """
    size = np.sqrt(np.diag(gram))
    used = size > 0
    scale = np.outer(size, size)[np.ix_(used, used)]
    lengths, turned = np.linalg.eigh(gram[np.ix_(used, used)] / scale)
    own = lengths > 1e-8 * lengths[-1]  # directions that are more than the rounding of others
    turned = turned[:, own] / np.sqrt(lengths[own])
    factors, mixed = np.linalg.eigh(turned.T @ (image[np.ix_(used, used)] / scale) @ turned)
    weights = np.zeros(len(size))
    weights[used] = turned @ mixed[:, -1] / size[used]
    return factors[-1], weights if weights[0] >= 0 else -weights


def _leading(scores: DataFrame, table: DataFrame, nodes: DataFrame, keys: list[str], tol: float) -> tuple[DataFrame, bool]:
    """Where the rounds from ``scores`` lead, and whether it was found as closely as ``tol`` and the arithmetic allow.

    Two rounds take hub scores to hub scores, by a symmetric matrix, and the same holds for authority scores. What they make
    of the start again and again spans a space; of all vectors in it, the one they stretch most is nearer to the limit
    than the last round is, and the limit of the rounds from there is the same (Lanczos; all vectors are kept at right
    angles). A page's row holds its place in each of these vectors, and only their products reach the driver. Where a
    vector is rounding only, the space holds the limit, and the vectors before it tell it.
    """
    held = scores.select("id", "blocks", *[F.col(s).alias(f"{s}_0") for s in SCORES])
    gram, image = ({s: np.zeros((0, 0)) for s in SCORES} for _ in range(2))
    basis, found = [], False
    weights, errors = {}, {}
    whole = set()  # scores whose vectors span all that two rounds make of them
    for step in range(SPANNING_STEPS):
        last = held.select("id", "blocks", *[F.col(f"{s}_{step}").alias(s) for s in SCORES])
        basis += [f"{s}_{step}" for s in SCORES]
        held = checkpoint(_updated(_updated(last, table, nodes, keys), table, held, keys))
        wanted = {(s, what, i): F.sum(F.col(f"{s}_{i}") * F.col(c)) for s in SCORES for i in range(step + 1)
                  for what, c in (("gram", f"{s}_{step}"), ("image", s))}
        wanted |= {(s, "length", 0): F.sum(F.col(s) * F.col(s)) for s in SCORES}
        row = held.agg(F.count("*"), *wanted.values()).first()
        sums = {key: value or 0.0 for key, value in zip(wanted, row[1:])}
        close = max(tol / 10 / math.sqrt(max(row[0], 1)), ROUNDING / 4)
        beyond = {s: F.lit(0.0).alias(f"{s}_{step + 1}") for s in SCORES}
        for s in SCORES:
            if s in whole:
                continue
            for what, table_of in (("gram", gram), ("image", image)):
                grown = np.zeros((step + 1, step + 1))
                grown[:step, :step] = table_of[s]
                grown[step] = grown[:, step] = [sums[s, what, i] for i in range(step + 1)]
                table_of[s] = grown
            length, column, own = sums[s, "length", 0], image[s][step], math.sqrt(gram[s][step, step])
            if step and own < NOISE:
                whole.add(s)
                continue
            if not (0 < length < math.inf and gram[s][0, 0] > 0):
                return scores, False  # there are no links
            factor, weights[s] = _weights(gram[s], image[s])
            along = np.linalg.pinv(gram[s], rcond=1e-12, hermitian=True) @ column
            # a smaller rest is not told by this difference
            rest = math.sqrt(max(length - along @ column, 1e-16 * length))
            errors[s] = rest * abs(weights[s][step]) / factor
            inside = sum((F.lit(float(x)) * F.col(f"{s}_{i}") for i, x in enumerate(along)), F.lit(0.0))
            beyond[s] = ((F.col(s) - inside) / F.lit(rest)).alias(f"{s}_{step + 1}")
        found = all(s in whole or errors[s] < close for s in SCORES)
        if found:
            break
        held = held.select("id", "blocks", *basis, *beyond.values())
    nearest = {s: sum((F.lit(float(x)) * F.col(f"{s}_{i}") for i, x in enumerate(weights[s])), F.lit(0.0)) for s in SCORES}
    # cut off at 0 only where what is below is rounding: more would change the shares of parts of equal strength
    nearest = [(_from_zero(x) if found else x).alias(s) for s, x in nearest.items()]
    return _normalized(checkpoint(held.select("id", "blocks", *nearest)), "l2"), found


def hits(edges: DataFrame, pages: DataFrame | None = None, rounds: int | None = None, normalize: str = "l2",
         stop: str = "rounds", tol: float = 1e-9, hub_block: int = HUB_BLOCK) -> DataFrame:
    """``id, hub, authority`` after ``rounds`` simultaneous updates, or when ``stop`` is met.

    Both scores start at 1 and come from the values of the round before; repeated links count each
    time. ``normalize`` divides by the root of the sum of squares (``l2``) or by that sum itself
    (``sumsq``). ``stop`` is ``rounds``, ``tol`` (summed change since the scores were last written) or ``histogram``
    (both score histograms keep the same perplexity four times). ``rounds`` is 100 where nothing else stops; with
    another stop there is no limit unless ``rounds`` gives one, and reaching it first is warned of.

    Every link is stored under both of its ends, so that a round is one join without a shuffle and
    one summed shuffle; the links of an end are one row of each direction. Pages with many links are split into blocks of
    keys, as in PageRank. A round is linear and ``l2`` only scales, so there ``ROUNDS_PER_WRITE`` rounds are one job that
    scales and writes at its end.

    ``tol`` with ``l2`` and without a limit wants what the rounds lead to, not a number of them. There :func:`_leading`
    says where that is, and plain rounds from there decide on the stop, where a change within their rounding is none. They come by twos, as scores that take
    turns for ever (several subgraphs of equal strength) do so from round to round; those of even rounds are given.
    """
    spark = edges.sparkSession
    edges = edges.select("src", "dst")
    if pages is not None:
        pages = checkpoint(pages.select("id").distinct())
        edges = subgraph(edges, pages)
    both = F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("other"), F.lit(True).alias("outward")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("other"), F.lit(False).alias("outward")))
    links = checkpoint(edges).select(F.inline(both))
    n_links = links.count()
    width = partitions_for(spark, n_links)
    hub_block = hub_block_for(n_links, hub_block)
    with steady_plans(spark, width):
        counts = links.groupBy("id").agg(F.count("*").alias("n"))
        if pages is not None:
            counts = pages.join(counts, "id", "left")
        blocks = F.greatest(F.ceil(F.coalesce("n", F.lit(0)) / F.lit(hub_block)), F.lit(1)).cast("int")
        nodes = counts.select("id", blocks.alias("blocks"))
        nodes = checkpoint(nodes.repartition(width, "id").sortWithinPartitions("id"))
        n_hubs = nodes.filter("blocks > 1").count()
        keys = ["id"]
        if n_hubs:
            keys = ["id", "part"]
            hubs = F.broadcast(nodes.filter("blocks > 1"))
            part = F.coalesce(F.pmod(F.xxhash64("other"), F.col("blocks")), F.lit(0)).cast("int")
            links = links.join(hubs, "id", "left").select("id", part.alias("part"), "other", "outward")
        # a round reads and joins one row for the links of an end, or of a block of a hub's
        table = links.repartition(width, *keys).groupBy(*keys, "outward").agg(F.collect_list("other").alias("others"))
        table = checkpoint(table.sortWithinPartitions(*keys))

        scores = nodes.select("id", "blocks", F.lit(1.0).alias("hub"), F.lit(1.0).alias("authority"))
        seen: dict[str, list[float]] = {"hub": [], "authority": []}
        limit = 100 if rounds is None and stop == "rounds" else rounds
        per_write, done = ROUNDS_PER_WRITE if normalize == "l2" and stop != "histogram" else 1, 0
        to_the_end, found = limit is None and stop == "tol" and normalize == "l2", False
        per_write += to_the_end and per_write % 2
        while limit is None or done < limit:
            if to_the_end and not found:
                scores, found = _leading(scores, table, nodes, keys, tol)
            else:
                found = False
            if stop == "histogram":
                for name, history in seen.items():
                    history.append(round(perplexity(scores, value=name).first().perplexity, 6))
                if all(is_stable(h) for h in seen.values()):
                    break
            raw, n_rounds = scores, per_write if limit is None else min(per_write, limit - done)
            for _ in range(n_rounds):
                raw = _updated(raw, table, nodes, keys)
            raw, done = checkpoint(raw), done + n_rounds
            before, scores = scores, _normalized(raw, normalize)
            if stop == "tol":
                old = before.select("id", F.col("hub").alias("h"), F.col("authority").alias("a"))
                moved = F.abs(F.col("hub") - F.col("h")) + F.abs(F.col("authority") - F.col("a"))
                change, size = scores.join(old, "id").agg(F.sum(moved), F.sum(F.col("hub") + F.col("authority"))).first()
                if (change or 0.0) < max(tol, ROUNDING * (size or 0.0) if to_the_end else 0.0):
                    break
        else:
            if stop != "rounds":
                warnings.warn(f"HITS did not meet its stop {stop!r} in {limit} rounds", stacklevel=2)
        if to_the_end:  # the rest of other directions may be less than 0
            scores = scores.withColumns({s: _from_zero(F.col(s)) for s in SCORES})
        return checkpoint(scores.select("id", "hub", "authority"))


def hits_top(scores: DataFrame, name: str, n: int = 500) -> DataFrame:
    """``id, score`` of the ``n`` best hubs or authorities; equal scores go by id."""
    return scores.select("id", F.col(name).alias("score")).orderBy(F.desc(F.round("score", 9)), "id").limit(n)
