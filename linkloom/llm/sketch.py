"""Threshold-scaled fingerprints: every shingle hash below a fixed fraction of the hash range is retained.

Two fingerprints use the same threshold whatever the sizes of their texts, so unions, likeness and containment
follow from the retained hashes alone, also between a line and a book. A fingerprint is the number of
shingles, a hash of the whole text and the retained hashes in order, all in hex. Texts too short to retain a
hash are told apart by the hash of the text: their likeness is 1 if equal, else 0.

A shingle is ``SHINGLE`` code points; a shorter text is one shingle. Null texts are empty. Repeated rows have
equal fingerprints. In the order of documents, rows of equal id are ordered by a hash of the text, and null
ids come after all others.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 16
HASH_BITS, SCALE_BITS = 40, 4
DIGITS = HASH_BITS // 4
BYTES_PER_RANGE = 1 << 25
MIN_ID = -(1 << 63)
EDITED = ("doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


BASE = 0x9E3779B97F4A7C15
STEPS = [(1 << k, np.uint64(pow(BASE, 1 << k, 1 << 64))) for k in range(SHINGLE.bit_length() - 1)]


def retained(points: np.ndarray) -> np.ndarray:
    """The distinct retained hashes of all shingles of a text's code points; shingles are hashed by doubling."""
    if len(points) < SHINGLE:
        values = np.array([xxhash.xxh64_intdigest(points.tobytes())], np.uint64)
    else:
        values = points.astype(np.uint64)
        for step, factor in STEPS:
            values = values[:-step] * factor + values[step:]
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    return np.unique(values[values < np.uint64(1 << (64 - SCALE_BITS))] >> np.uint64(64 - HASH_BITS))


def sketch(text: str) -> tuple[int, int, np.ndarray]:
    """Number of shingles, hash of the text, retained hashes."""
    data = text.encode("utf-32-le")
    kept = retained(np.frombuffer(data, np.uint32)) if text else np.zeros(0, np.uint64)
    return max(len(text) - SHINGLE + 1, min(1, len(text))), xxhash.xxh64_intdigest(data), kept


def written(parts: tuple[int, int, np.ndarray]) -> str:
    count, whole, kept = parts
    digits = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8:].tobytes().hex()
    return f"{count:x}.{whole:016x}.{digits}"


def read(fingerprint: str) -> tuple[int, int, np.ndarray]:
    count, whole, digits = fingerprint.split(".")
    wide = np.zeros((len(digits) // DIGITS, 8), np.uint8)
    wide[:, 8 - HASH_BITS // 8:] = np.frombuffer(bytes.fromhex(digits), np.uint8).reshape(-1, HASH_BITS // 8)
    return int(count, 16), int(whole, 16), wide.view(">u8").ravel().astype(np.uint64)


def likeness(a: tuple[int, int, np.ndarray], b: tuple[int, int, np.ndarray]) -> float:
    """Estimated share of common shingles among all shingles of both."""
    if a[1] == b[1]:
        return 1.0
    both = len(np.intersect1d(a[2], b[2], assume_unique=True))
    either = len(a[2]) + len(b[2]) - both
    return both / either if either else 0.0


def containment(a: tuple[int, int, np.ndarray], b: tuple[int, int, np.ndarray]) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    if a[1] == b[1]:
        return 1.0
    return len(np.intersect1d(a[2], b[2], assume_unique=True)) / len(a[2]) if len(a[2]) else 0.0


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.pandas_udf("string")
    def written_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: written(sketch(t)))

    return written_of(F.coalesce(text, F.lit("")))


def merged(rows: DataFrame, group: list[str], name: str = "fingerprint") -> DataFrame:
    """``group, hashes, n``: the union of the retained hashes of each group and their number.

    The hashes are exploded and counted once, so a group of any size is merged before and after the shuffle.
    """
    digits = F.split(F.col(name), r"\.")[2]
    each = F.sequence(F.lit(1), F.char_length(digits) - DIGITS + 1, F.lit(DIGITS))
    hashes = F.when(digits == "", F.array().cast("array<string>")).otherwise(
        F.transform(each, lambda i: F.substr(digits, i, F.lit(DIGITS))))
    distinct = rows.select(*group, F.explode(hashes).alias("hash")).distinct()
    return distinct.groupBy(*group).agg(F.count("*").alias("n_hashes"),
                                        (F.count("*") * (1 << SCALE_BITS)).alias("n_shingles"))


def ranges(docs: DataFrame) -> list[int]:
    """Bounds that cut the ids into ranges of about ``BYTES_PER_RANGE`` of text: one number a range."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, math.ceil(size / BYTES_PER_RANGE))
    found = docs.agg(F.percentile_approx("_id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0]
    return sorted(set(found or []))


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``_range, _edge, _id, _hash, doc_id, text`` for :func:`edited`, and the number of ranges.

    Documents fall into ranges of ids. The first document of a range is also added as an edge after the last
    one of the range before it, going down, so that every document finds its successor in its own range.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_ID)).alias("_id"))
    bounds = np.array(ranges(docs), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32))

    docs = docs.withColumn("_range", range_of("_id"))
    tops = docs.groupBy("_range").agg(F.max("_id").alias("_id")).collect()
    tops = sorted((r["_range"], r["_id"]) for r in tops)
    docs = docs.withColumn("_hash", F.xxhash64("text"))
    if not tops:
        return docs.withColumn("_edge", F.lit(0)), 1
    before = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}
    found = docs.sparkSession.createDataFrame(pa.table({
        "_id": pa.array(list(before), pa.int64()), "_to": pa.array(list(before.values()), pa.int32())}))
    edges = docs.join(F.broadcast(found), "_id")  # one row a range
    edges = edges.groupBy("_to").agg(F.max(F.struct("_id", "_hash", "text")).alias("top")).select(
        F.col("_to").alias("_range"), F.lit(1).alias("_edge"), "top.*",
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"))
    names = ["_range", "_edge", "_id", "_hash", "doc_id", "text"]
    return docs.withColumn("_edge", F.lit(0)).select(names).union(edges.select(names)), len(tops)


def edited(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint and that of its edited text, and how near they are.

    The edited text has its last third replaced by the beginning of the next document, in descending order of
    ids; the first document follows the last.
    """
    rows, parts = with_next(docs)
    kind = docs.schema["doc_id"].dataType
    schema = EDITED.format(kind=kind.simpleString())
    rows = rows.repartition(parts, "_range").sortWithinPartitions("_range", "_edge", F.desc("_id"), F.desc("_hash"))
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for part, edge, doc_id, text in rows_of(batch):
                own = sketch(text)
                if held is not None and held[0] == part:
                    out.append(compared(held[1], held[2], held[3], text, own))
                held = None if edge else (part, doc_id, text, own)
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field("doc_id").type), pa.array(columns[1], pa.int64()),
                     *(pa.array(c, pa.string()) for c in columns[2:5]),
                     *(pa.array(c, pa.float64()) for c in columns[5:])], names=names)

    return rows.mapInArrow(run, schema)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in ("_range", "_edge", "doc_id", "text")))


def compared(doc_id, text: str, own: tuple, following: str, following_sketch: tuple) -> tuple:
    third = len(text) // 3
    changed = text[:len(text) - third] + following[:third]
    other = sketch(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), written(own), written(other),
            likeness(own, other), likeness(own, following_sketch))
