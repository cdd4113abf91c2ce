"""The crawl frontier as tables: selection, priority, batches, politeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.scores import frontier_score, inlink_score
from linkloom.operators.numbering import place_rows

BATCH_STEP = 500
SHARES = 8


def unvisited(queue: DataFrame, completed: DataFrame) -> DataFrame:
    """Queue entries ``url, …`` not in ``completed(url)``, each URL once with its lowest level."""
    once = queue.groupBy("url").agg(F.min("level").alias("level"))
    return once.join(completed.select("url").distinct(), "url", "left_anti").select("level", "url")


def new_links(links: DataFrame, seen: DataFrame) -> DataFrame:
    """``url``: distinct links not seen before. A link found often is brought down to one row first."""
    return links.select("url").distinct().join(seen.select("url"), "url", "left_anti")


def score_frontier(queue: DataFrame, inlinks: DataFrame, **terms) -> DataFrame:
    """``link, wave, score, inlink_score`` for ``level, url``; ``inlinks`` has ``url, n_inlinks``."""
    known = queue.join(inlinks, "url", "left")
    return known.select(
        F.col("url").alias("link"), F.col("level").alias("wave"),
        frontier_score(F.col("url"), F.col("level"), F.col("n_inlinks"), **terms).alias("score"),
        inlink_score(F.col("n_inlinks")).alias("inlink_score"))


def take_batch(queue: DataFrame, n: int) -> DataFrame:
    """The first ``n`` entries by level and URL."""
    return queue.orderBy("level", "url").limit(n)


def admit(queue_size: int, found: DataFrame, capacity: int | None = None) -> DataFrame:
    """New entries ``level, url`` the queue still has room for, first by level and URL; all of them without a limit."""
    if capacity is None:
        return found
    return found.orderBy("level", "url").limit(max(capacity - queue_size, 0))


def politeness_audit(log: DataFrame, delay: float = 1.0, patience: float = 5.0) -> DataFrame:
    """``access_id, host, gap, to_sleep, action`` for an access log ``access_id, host, ts``.

    ``gap`` is the time since the host's last access, ``to_sleep`` what the delay leaves of it; more
    than ``patience`` skips the URL, anything above 0 waits. Accesses without a time come first and have no gap;
    those without a host are one host; equal rows are separate accesses.

    The log is sorted by host and time into ranges of rows, whatever hosts they hold. Inside a range an access
    looks at the one before it; a range's first access looks at the last one of the range before, one row per range.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    placed = place_rows(log.select("access_id", "host", at.alias("at")), [F.col("host"), F.col("at"), F.col("access_id")])
    access = F.struct("host", "at")
    lasts = placed.groupBy("_range").agg(F.max_by(access, "_at").alias("last"))
    carried = lasts.select("_range", F.lag("last").over(Window.orderBy("_range")).alias("_carried"))
    inside = Window.partitionBy("_range").orderBy("_at")
    rows = placed.withColumn("_before", F.lag(access).over(inside)).join(F.broadcast(carried), "_range")
    previous = F.coalesce("_before", "_carried")
    gap = F.when(previous["host"].eqNullSafe(F.col("host")), (F.col("at") - previous["at"]) / F.lit(1_000_000.0))
    to_sleep = F.lit(float(delay)) - F.col("gap")
    action = (
        F.when(F.col("gap").isNull() | (to_sleep <= 0), "go").when(to_sleep > patience, "skip").otherwise("wait"))
    return rows.withColumn("gap", gap).select("access_id", "host", "gap", to_sleep.alias("to_sleep"),
                                              action.alias("action"))
