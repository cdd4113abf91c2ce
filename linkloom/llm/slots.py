"""Sharding over fixed virtual slots.

Every record hashes into one of thousands of slots and never leaves it. The bytes of each slot are
summed, and a versioned table says which shard holds which slot. Rebalancing or adding a shard edits
that table: only the slots it moves change their place, the hash of a record never does. The table has
as many rows as there are slots, so it may be broadcast and edited on the driver at any input size.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192
MAP_SCHEMA = "slot int, shard int, bytes long, rows long"


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of each row; a null text counts as empty.

    The hash takes the whole record, so that rows without an id spread as others do. Rows that are equal
    in all of it share a slot.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("virtual_slot", slot_of(["doc_id", "size", "text_crc32"], slots))


def slot_of(key: list[str | Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def loads(rows: DataFrame, slots: int = SLOTS) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot; one row a slot reaches the driver."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    held = {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in found}
    return {slot: held.get(slot, (0, 0)) for slot in range(slots)}


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Version 1: equal runs of slots, whatever they hold."""
    return {slot: slot * shards // slots for slot in range(slots)}


def rebalance(placed: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """A new version of the map with shards of near equal bytes, moving slots only out of shards above the mean.

    Shards above the mean give up their largest slots, as long as they stay above it, and each of those goes to
    the lightest shard. Then the
    heaviest and the lightest shard exchange slots as long as that brings them closer.
    """
    mean = sum(sizes.values()) / shards
    held: list[set[int]] = [set() for _ in range(shards)]
    free = []
    for slot, shard in placed.items():
        (held[shard].add(slot) if shard < shards else free.append(slot))
    total = [sum(sizes[s] for s in group) for group in held]
    for shard, group in enumerate(held):
        for slot in sorted(group, key=lambda s: (-sizes[s], s)):
            if sizes[slot] and total[shard] - sizes[slot] >= mean:
                group.remove(slot)
                total[shard] -= sizes[slot]
                free.append(slot)
    lightest = [(load, shard) for shard, load in enumerate(total)]
    heapq.heapify(lightest)
    for slot in sorted(free, key=lambda s: (-sizes[s], s)):
        load, shard = heapq.heappop(lightest)
        held[shard].add(slot)
        total[shard] = load + sizes[slot]
        heapq.heappush(lightest, (total[shard], shard))
    while exchange(held, total, sizes):
        pass
    return {slot: shard for shard, group in enumerate(held) for slot in group}


def exchange(held: list[set[int]], total: list[int], sizes: dict[int, int]) -> bool:
    """Move or swap the slots that bring the heaviest and the lightest shard closest; False if none does."""
    heavy, light = total.index(max(total)), total.index(min(total))
    gap = total[heavy] - total[light]
    others = sorted((sizes[s], s) for s in held[light])
    best = (gap, None, None)
    for slot in held[heavy]:
        wanted = sizes[slot] - gap / 2
        at = bisect_left(others, (wanted, -1))
        for back in [(0, None), *others[max(0, at - 1):at + 1]]:
            best = min(best, (abs(gap - 2 * (sizes[slot] - back[0])), slot, back[1]), key=lambda x: x[0])
    left, slot, back = best
    if slot is None or left >= gap:
        return False
    for moved, source, target in ((slot, heavy, light), (back, light, heavy)):
        if moved is not None:
            held[source].remove(moved)
            held[target].add(moved)
            total[source] -= sizes[moved]
            total[target] += sizes[moved]
    return True


def save_map(spark: SparkSession, folder: str, version: int, placed: dict[int, int],
             held: dict[int, tuple[int, int]]) -> None:
    """Store one version; a version is never changed afterwards."""
    slots = sorted(placed)
    rows = pa.table({"slot": pa.array(slots, pa.int32()), "shard": pa.array([placed[s] for s in slots], pa.int32()),
                     "bytes": pa.array([held[s][0] for s in slots], pa.int64()),
                     "rows": pa.array([held[s][1] for s in slots], pa.int64())})
    spark.createDataFrame(rows).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}")


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """What an edit moves: ``slot, from_shard, to_shard, bytes``."""
    old = before.select("slot", F.col("shard").alias("from_shard"))
    return after.join(old, "slot").filter("shard <> from_shard").select(
        "slot", "from_shard", F.col("shard").alias("to_shard"), "bytes")


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each row's shard, and its place there, gapless from 0: by slot, within a slot by id, checksum and size.

    A row's place is the rows in its shard's earlier slots plus its number within its slot, so no task sees
    more than a slot. Rows equal in id, checksum and size take any of their places.
    """
    earlier = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(F.col("slot").alias("virtual_slot"), "shard",
                             F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_at", F.row_number().over(within))
    return numbered.join(F.broadcast(starts), "virtual_slot").withColumn("slot", F.col("_before") + F.col("_at") - 1)
