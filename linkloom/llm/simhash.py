"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly if some value lies within r bits of both. Every distinct
fingerprint therefore emits all values within half the radius, and those that meet on a value are linked. The
values are shuffled by their first bits: a fingerprint is sent once to each prefix its values can have, and
its values with that prefix are made there, which keeps the shuffle small. All fingerprints that meet on one
value are within the radius of each other, so they are linked in a star; no pairs within a group are formed.

Rows of equal fingerprint, null texts and texts without words among them, are one node. A null id can be in a
component but names one only where no other id does. Texts of any length are hashed whole.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import forget, map_arrow, saved
from linkloom.llm.components import roots

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
VALUES_PER_GROUP = 1 << 21


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> bytes:
    """Eight bytes, high bit first: a bit is set if it is in more than half the shingles' hashes."""
    words = (text or b"").lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], seed) for s, e in zip(
        starts[:len(words) - last].tolist(), ends[last:].tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.uint32) > len(bits)).tobytes()


def fingerprints(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``key, fp``: the fingerprint of each text as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> dict:
        found = b"".join([fingerprint(t, shingle) for t in batch.column(1).to_pylist()])
        return {key: batch.column(0), "fp": np.frombuffer(found, ">i8").astype(np.int64)}

    rows = docs.select(key, F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, make, f"{key} {kind}, fp long")


@lru_cache(maxsize=None)
def flips(width: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` bits among the low ``width`` bits, for ``most`` up to 2."""
    one = np.left_shift(np.uint64(1), np.arange(width, dtype=np.uint64))
    masks = [np.zeros(1, np.uint64)]
    if most >= 1:
        masks.append(one)
    if most >= 2:
        first, second = np.triu_indices(width, 1)
        masks.append(one[first] | one[second])
    return np.concatenate(masks)


def met(fps: np.ndarray, prefix: int, width: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of fingerprints that meet on a value beginning with ``prefix``, each with the first it meets there.

    Where the values would be too many for one sort, the prefix is made longer and its parts are done in turn.
    """
    rest = BITS - width
    apart = np.bitwise_count((fps >> np.uint64(rest)) ^ np.uint64(prefix))
    sizes = [int((apart == d).sum()) for d in range(reach + 1)]
    if sum(n * len(flips(rest, reach - d)) for d, n in enumerate(sizes)) > 2 * VALUES_PER_GROUP and rest > 8:
        parts = []
        for low in range(16):
            longer, wide = prefix << 4 | low, width + 4
            near = np.flatnonzero(np.bitwise_count((fps >> np.uint64(BITS - wide)) ^ np.uint64(longer)) <= reach)
            a, b = met(fps[near], longer, wide, reach)
            parts.append((near[a], near[b]))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    low = fps & np.uint64((1 << rest) - 1)
    values, places = [], []
    for distance in range(reach + 1):
        at = np.flatnonzero(apart == distance)
        masks = flips(rest, reach - distance)
        values.append((low[at][:, None] ^ masks[None, :]).ravel())
        places.append(np.repeat(at.astype(np.int32), len(masks)))
    value, place = np.concatenate(values), np.concatenate(places)
    in_order = np.sort(value)
    shared = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(shared):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    shared = np.unique(shared)
    at = np.searchsorted(shared, value)
    at[at == len(shared)] = 0
    hit = shared[at] == value
    group, place = at[hit], place[hit]
    order = np.lexsort((place, group))
    group, place = group[order], place[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    head = np.repeat(place[first], np.diff(np.r_[first, len(group)]))
    other = place != head
    return place[other], head[other]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place each of ``n`` places is linked to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links that join all fingerprints of ``fp`` (distinct) within ``radius`` bits into their components."""
    reach = radius // 2
    if radius % 2 or reach > 2:
        raise ValueError("the radius must be 0, 2 or 4")
    ball = sum(math.comb(BITS, k) for k in range(reach + 1))
    groups = distinct.count() * ball / VALUES_PER_GROUP
    width = min(24, max(5, math.ceil(math.log2(groups)) if groups > 1 else 0))
    prefixes = [int(m) - (1 << 64) if int(m) >> 63 else int(m) for m in flips(width, reach)]
    spread = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in prefixes])).alias("mask")).select(
        F.shiftrightunsigned("fp", BITS - width).bitwiseXOR(F.col("mask")).alias("prefix"), "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        forget()
        signed = np.unique(rows.column("fp").to_numpy())
        a, b = met(signed.view(np.uint64), key[0].as_py(), width, reach)
        label = forest(len(signed), a, b)
        hung = np.flatnonzero(label != np.arange(len(signed)))
        apart = np.bitwise_count((signed[a] ^ signed[b]).view(np.uint64))
        if len(apart) and apart.max() > radius:
            raise AssertionError("fingerprints that meet must be within the radius")
        out = pa.Table.from_arrays([pa.array(signed[hung]), pa.array(signed[label[hung]])], schema=schema)
        return out

    return spread.repartition(1 << max(3, width - 1), "prefix").groupBy("prefix").applyInArrow(
        meet, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``key, fp, component_id`` of every row: the smallest id reachable over links within ``radius``."""
    rows = saved(fingerprints(docs, key, shingle), "simhash-rows")
    nodes = saved(rows.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    root = roots(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = nodes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(linked.select("fp", "root").join(least, "root").select("fp", "component_id"), "simhash-names")
    return rows.join(named, "fp").select(key, "fp", "component_id")
