"""Removal of long repeated byte strings, by a logarithmic family of suffix arrays per shard of the suffix space.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id. Equal
strings must meet in one place: each string belongs to the shard of its least byte gram, and neighbouring
strings with the same least gram travel together as one stretch of text. Grams that are frequent in a small
sample are put last in the order, which spreads the load; the sample has no influence on the result.

In its shard, stretches arrive in the order of ids, cut into batches. Every batch gets a suffix array: its
suffixes, cut at ``LENGTH`` bytes, sorted by the fingerprint of these bytes (only equality matters, so this
order does for the lexicographic one). It is merge-scanned against the existing levels, what is new becomes a
level, and levels of equal size are merged, so a shard has logarithmically many. Every match is compared byte by
byte. Stretches that are equal within a map task are sent once, so a passage of a third of all documents
arrives as a few rows a task.

Null texts are empty. A null id counts as larger than all others. Documents with equal ids are not each other's
source. Rows equal in id and text get the same result. Texts of any length are cut whole. Other columns stay as they
are, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import MAX_ID, forget, hand_back, map_arrow

LENGTH = 50
GRAM = 8
ORDER_BITS = 16
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 4096
STRINGS_PER_SHARD, PARTS, PARTS_HELD = 1 << 25, 16, 2
STRINGS_PER_BATCH = 1 << 18
LONGEST_STRETCH = 255
FLUSH_BYTES = 1 << 25
COMPARED_BYTES = 1 << 20
SPANS = "doc_id long, text_hash long, spans array<int>"


def words64(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as integers."""
    return np.ndarray((max(0, len(data) - 7),), np.uint64, data, 0, (1,))


def mixed(values: np.ndarray) -> np.ndarray:
    out = values * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def gram_classes(texts: list[bytes]) -> np.ndarray:
    """For each bucket of grams, how often it comes in a sample, as a power of two."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < GRAM:
        return np.zeros(1 << ORDER_BITS, np.uint8)
    buckets = mixed(words64(data)) >> np.uint64(64 - ORDER_BITS)
    counts = np.bincount(buckets.astype(np.int64), minlength=1 << ORDER_BITS)
    return np.minimum(15, np.log2(counts + 1)).astype(np.uint8)


def least_grams(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For the string at each place, the order value of its least gram."""
    order = mixed(words64(data))
    rank = classes[(order >> np.uint64(64 - ORDER_BITS)).astype(np.int64)].astype(np.uint64)
    least = (order >> np.uint64(4)) | (rank << np.uint64(60))
    width, reach = LENGTH - GRAM + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def stretches(texts: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``data, document, start in data, start in document, strings, least gram`` of each stretch of the texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts) + bytes(LENGTH), np.uint8)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    fit = np.flatnonzero(sizes >= LENGTH)
    if not len(fit):
        none = np.zeros(0, np.int64)
        return data, none, none, none, none, none.astype(np.uint64)
    least = least_grams(data, classes)
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.unique(np.concatenate([cut, begins[fit]]))
    starts = starts[starts < ends[-1]]
    document = np.searchsorted(ends, starts, "right")
    last = ends[document] - LENGTH + 1
    stop = np.minimum(np.r_[starts[1:], len(data)], last)
    keep = stop > starts
    starts, stop, document = starts[keep], stop[keep], document[keep]
    pieces = -(-(stop - starts) // LONGEST_STRETCH)
    if pieces.max(initial=1) > 1:
        stop, document = np.repeat(stop, pieces), np.repeat(document, pieces)
        starts = gathered_steps(starts, pieces)
        stop = np.minimum(stop, starts + LONGEST_STRETCH)
    return data, document, starts, starts - begins[document], stop - starts, least[starts]


def gathered_steps(starts: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Each start, and so many places after it as there are pieces, a longest stretch apart."""
    within = gathered(np.zeros(len(pieces), np.int64), pieces)
    return np.repeat(starts, pieces) + LONGEST_STRETCH * within


def planes(values: np.ndarray, width: int = 4) -> bytes:
    """Integers of so many bytes as as many runs of bytes, which pack better."""
    return values.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(raw: bytes, n: int, at: int, width: int = 4) -> np.ndarray:
    return np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n).T.copy().view(f"<i{width}").ravel()


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int((starts + sizes).max(initial=0))) < 1 << 31 else np.int64
    out = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    out += np.arange(total, dtype=kind)
    return out


def string_prints(data: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the ``LENGTH`` bytes from each place on."""
    words = words64(data)
    n = len(data) - LENGTH + 1
    out = np.zeros(max(0, n), np.uint64)
    for at, offset in enumerate([*range(0, LENGTH - 7, 8), LENGTH - 8]):
        out += words[offset:offset + n] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * at + 1, 1 << 64))
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def equal_strings(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    words, same = words64(data), np.ones(len(a), bool)
    for offset in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        same &= words[a + offset] == words[b + offset]
    return same


class Outbox:
    """Stretches of a map task, packed into one row per shard whenever enough have come together."""

    def __init__(self, classes: np.ndarray, shards: int):
        self.classes, self.shards = classes, shards
        self.clear()

    def clear(self) -> None:
        self.parts, self.ids, self.hashes, self.size, self.docs = [], [], [], 0, 0
        self.seen: set[tuple[int, int]] = set()

    def add(self, ids: np.ndarray, hashes: np.ndarray, texts: list[bytes]) -> None:
        """Rows equal in id and text are sent once, as they have the same spans."""
        fresh = []
        for at, key in enumerate(zip(ids.tolist(), hashes.tolist())):
            if key not in self.seen:
                self.seen.add(key)
                fresh.append(at)
        if len(fresh) < len(texts):
            ids, hashes, texts = ids[fresh], hashes[fresh], [texts[at] for at in fresh]
        data, document, start, place, strings, least = stretches(texts, self.classes)
        content = data[gathered(start, strings + LENGTH - 1)]
        self.parts.append((document + self.docs, place, strings, least, stretch_keys(data, start, strings), content))
        self.ids.append(ids)
        self.hashes.append(hashes)
        self.docs += len(ids)
        self.size += len(content)

    def flush(self) -> tuple[list[tuple], dict]:
        """Rows ``shard, packed`` to send, and the spans of stretches that an earlier document here has too, which go to
        the shards of their stretches."""
        document, place, strings, least, key, content = (np.concatenate(x) for x in zip(*self.parts))
        ids, hashes = np.concatenate(self.ids), np.concatenate(self.hashes)
        self.clear()
        sizes = strings + LENGTH - 1
        ends = np.cumsum(sizes)
        begins = ends - sizes
        repeated = repeats(key, content, begins, sizes, ids[document])
        spread = mixed(least)
        shard = (spread % np.uint64(self.shards)).astype(np.int64)
        known = np.unique(shard[repeated] * len(ids) + document[repeated])  # a row for each shard and document
        row = np.searchsorted(known, shard[repeated] * len(ids) + document[repeated])
        spans = span_columns(ids[known % len(ids)], hashes[known % len(ids)], row, place[repeated], (place + sizes)[repeated])
        spans["shard"] = (known // len(ids)).astype(np.int32)
        keep = np.flatnonzero(~repeated)
        spread, shard = spread[keep], shard[keep]
        part = (spread // np.uint64(self.shards) % np.uint64(PARTS)).astype(np.int64)
        order = np.argsort(shard * PARTS + part, kind="stable")
        keep, shard, part = keep[order], shard[order], part[order]
        rows, packer = [], zstandard.ZstdCompressor(level=3)
        for a, b in runs(shard):
            own = keep[a:b]
            docs, index = np.unique(document[own], return_inverse=True)
            rows.append((int(shard[a]), packer.compress(b"".join([
                np.array([len(docs), len(own)], np.int64).tobytes(),
                np.bincount(part[a:b], minlength=PARTS).astype(np.int64).tobytes(),
                planes(np.diff(ids[docs], prepend=0), 8), hashes[docs].tobytes(), planes(np.diff(index, prepend=0)),
                planes(np.diff(place[own], prepend=0)), strings[own].astype(np.uint8).tobytes(),
                content[gathered(begins[own], sizes[own])].tobytes()]))))
        return rows, spans


def unpacked(packed: bytes | pa.Buffer) -> tuple[np.ndarray, ...]:
    """``stretches by part, ids, hashes, document, place, strings, text`` of a packed row."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    docs, count = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16 + 8 * PARTS
    parts = np.frombuffer(raw, np.int64, PARTS, 16)
    ids, hashes = np.cumsum(from_planes(raw, docs, at, 8)), np.frombuffer(raw, np.int64, docs, at + 8 * docs)
    at += 16 * docs
    document, place = from_planes(raw, count, at), from_planes(raw, count, at + 4 * count)
    at += 8 * count
    strings = np.frombuffer(raw, np.uint8, count, at).astype(np.int64)
    return (parts, ids, hashes, np.cumsum(document, dtype=np.int64), np.cumsum(place, dtype=np.int64), strings,
            np.frombuffer(raw, np.uint8, offset=at + count))


def stretch_keys(data: np.ndarray, start: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """A hash of each stretch: the sum of its strings' fingerprints, mixed with the first one and their number."""
    prints = string_prints(data)
    total = np.r_[np.uint64(0), np.cumsum(prints)]
    return (total[start + strings] - total[start]) ^ mixed(prints[start] + strings.astype(np.uint64))


def repeats(key: np.ndarray, content: np.ndarray, begins: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which stretches are byte for byte the same as one of a smaller id; the keys only say what to compare."""
    out = np.zeros(len(begins), bool)
    if not len(begins):
        return out
    order = np.lexsort((ids, key))
    key, first = key[order], np.r_[True, key[order][1:] != key[order][:-1]]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    later = (ids[order] > ids[head]) & (sizes[order] == sizes[head])
    own, source = order[later], head[later]
    block = np.cumsum(sizes[own]) // COMPARED_BYTES
    for a, b in runs(block):
        size = sizes[own[a:b]]
        same = content[gathered(begins[own[a:b]], size)] == content[gathered(begins[source[a:b]], size)]
        out[own[a:b]] = np.logical_and.reduceat(same, np.cumsum(size) - size)
    return out


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(0, np.int64)
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def span_columns(ids, hashes, document, begin, end, in_rows: bool = False) -> dict:
    """Spans by document, as columns of ``SPANS``; the documents come in runs.

    ``ids`` and ``hashes`` are those of each document, or of each span if ``in_rows``.
    """
    order = np.argsort(document, kind="stable")
    document, pairs = document[order], np.stack([begin, end], 1)[order]
    first = np.flatnonzero(np.r_[True, document[1:] != document[:-1]]) if len(document) else np.zeros(0, np.int64)
    offsets = np.r_[first, len(document)].astype(np.int32) * 2
    values = pa.array(pairs.astype(np.int32).ravel())
    owner = order[first] if in_rows else document[first]
    return {"doc_id": ids[owner], "text_hash": hashes[owner],
            "spans": pa.ListArray.from_arrays(pa.array(offsets), values)}


def merged_columns(ids: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> dict:
    """Columns of ``SPANS`` with one row for each id and hash and each of its spans once; ``sizes`` are spans a row."""
    pairs = values.reshape(-1, 2).astype(np.int32)
    ids, hashes = np.repeat(ids, sizes), np.repeat(hashes, sizes)
    order = np.lexsort((pairs[:, 1], pairs[:, 0], hashes, ids))
    ids, hashes, pairs = ids[order], hashes[order], pairs[order]
    apart = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    keep = np.flatnonzero(np.r_[True, apart | (pairs[1:] != pairs[:-1]).any(axis=1)][:len(ids)])
    ids, hashes, pairs = ids[keep], hashes[keep], pairs[keep]
    row = np.cumsum(np.r_[0, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])])[:len(ids)]
    return span_columns(ids, hashes, row, pairs[:, 0], pairs[:, 1], in_rows=True)


class Family:
    """Suffix arrays of one shard, in levels whose sizes grow geometrically."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.odd: dict[bytes, int] = {}

    def scan(self, places: np.ndarray, prints: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Which of a batch's strings start in an earlier document, here or in a level; the new ones make a level.

        ``places`` are in the order of ``ranks``, the order of ids.
        """
        order = np.argsort(prints)
        sorted_prints = prints[order]
        first = np.flatnonzero(np.r_[True, sorted_prints[1:] != sorted_prints[:-1]])
        group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
        head = np.minimum.reduceat(order, first)
        keys, source, rank = sorted_prints[first], places[head], ranks[head].astype(np.int32)
        fresh = np.ones(len(keys), bool)
        for level_keys, level_source, level_rank in self.levels:
            at = np.searchsorted(level_keys, keys)
            at[at == len(level_keys)] = 0
            known = level_keys[at] == keys
            source[known], rank[known] = level_source[at[known]], level_rank[at[known]]
            fresh &= ~known
        out = np.zeros(len(places), bool)
        check = np.flatnonzero((source[group] != places[order]))
        own, other = order[check], group[check]
        same = equal_strings(self.data, places[own], source[other])
        out[own] = same & (rank[other] < ranks[own])
        for i in np.sort(own[~same]):  # equal fingerprints of different strings
            key = self.data[places[i]:places[i] + LENGTH].tobytes()
            out[i] = self.odd.setdefault(key, int(ranks[i])) < ranks[i]
        self.insert(keys[fresh], source[fresh], rank[fresh])
        return out

    def insert(self, keys: np.ndarray, source: np.ndarray, rank: np.ndarray) -> None:
        new = (keys, source, rank)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(new[0]):
            old = self.levels.pop()
            keys = np.concatenate([old[0], new[0]])
            order = np.argsort(keys, kind="stable")  # merges two sorted runs
            new = (keys[order], *(np.concatenate([a, b])[order] for a, b in zip(old[1:], new[1:])))
        self.levels.append(new)


def scan_shard(packed: list) -> dict:
    """The spans to remove that one shard finds, from all stretches sent to it.

    Only the packed rows stay in memory; a few parts of the shard at a time are unpacked and scanned.
    """
    heads = [unpacked(p)[1:3] for p in packed]
    shift = np.cumsum([0] + [len(i) for i, _ in heads])
    ids, hashes = (np.concatenate([h[k] for h in heads]) for k in (0, 1))
    del heads
    rank_of = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    found = []
    for first_part in range(0, PARTS, PARTS_HELD):
        held = [[] for _ in range(PARTS_HELD)]
        for row, first in zip(packed, shift.tolist()):
            counts, _, _, docs, places, sizes, data = unpacked(row)
            stretch_ends = np.r_[0, np.cumsum(counts)].tolist()
            for k in range(PARTS_HELD):
                own = slice(stretch_ends[first_part + k], stretch_ends[first_part + k + 1])
                byte = int(sizes[:own.start].sum()) + own.start * (LENGTH - 1)
                upto = byte + int(sizes[own].sum()) + (own.stop - own.start) * (LENGTH - 1)
                held[k].append(((docs[own] + first).astype(np.int32), places[own].astype(np.int32),
                                sizes[own].copy(), data[byte:upto].copy()))
        for k in range(PARTS_HELD):
            columns, held[k] = [np.concatenate(x) for x in zip(*held[k])], None
            found += scan_part(*columns, rank_of)
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
    return span_columns(ids, hashes, *columns)


def scan_part(document: np.ndarray, place: np.ndarray, strings: np.ndarray, data: np.ndarray,
              rank_of: np.ndarray) -> list[tuple]:
    """``document, begin, end`` of the spans to remove, batch by batch in the order of ids."""
    sizes = strings + LENGTH - 1
    begins = np.cumsum(sizes) - sizes
    order = np.lexsort((place, document, rank_of[document]))
    document, place, strings, begins = document[order], place[order], strings[order], begins[order]
    done = np.cumsum(strings)
    family, found, at = Family(data), [], 0
    while at < len(order):
        upto = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + STRINGS_PER_BATCH, "right")))
        own = slice(at, upto)
        size = strings[own] + LENGTH - 1
        local = data[gathered(begins[own], size)]
        prints = string_prints(local)[gathered(np.cumsum(size) - size, strings[own])]
        places = gathered(begins[own], strings[own])
        stretch = np.repeat(np.arange(at, upto), strings[own])
        hit = np.flatnonzero(family.scan(places.astype(np.uint32), prints, rank_of[document[stretch]].astype(np.int32)))
        if len(hit):
            owner = stretch[hit]
            where = place[owner] + (places[hit] - begins[owner])
            start = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (owner[1:] != owner[:-1])])
            stop = np.r_[start[1:], len(hit)] - 1
            found.append((document[owner[start]], where[start], where[stop] + LENGTH))
        at = upto
    return found


def route(docs: DataFrame, classes: np.ndarray, shards: int) -> DataFrame:
    """``shard, packed`` rows of stretches, and rows of spans found on the way (with a null ``packed``)."""
    schema = pa.schema([("shard", pa.int32()), ("packed", pa.binary()), ("doc_id", pa.int64()),
                        ("text_hash", pa.int64()), ("spans", pa.list_(pa.int32()))])

    def batches(box: Outbox) -> Iterator[pa.RecordBatch]:
        rows, spans = box.flush()
        n, m = len(rows), len(spans["doc_id"])
        for at in range(0, n, 16):
            part = rows[at:at + 16]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary()),
                 *(pa.nulls(len(part), f.type) for f in list(schema)[2:])], schema=schema)
        if m:
            yield pa.RecordBatch.from_arrays(
                [pa.array(spans["shard"]), pa.nulls(m, pa.binary()), pa.array(spans["doc_id"]),
                 pa.array(spans["text_hash"]), spans["spans"]], schema=schema)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        box = Outbox(classes, shards)
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                box.add(part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).to_pylist())
                if box.size >= FLUSH_BYTES:
                    yield from batches(box)
        if box.parts:
            yield from batches(box)
        hand_back()

    return docs.select("doc_id", "text_hash", "data").mapInArrow(run, f"shard int, packed binary, {SPANS}")


def keyed(docs: DataFrame) -> DataFrame:
    """``_row, _id, _data, _hash``: all columns but the text as one, so that no name meets another; what tells rows
    apart, the id as a long, never null, and a hash of the text; and the text's bytes."""
    own = F.struct("*").dropFields("text")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(own.alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_ID)).alias("_id"),
                       data.alias("_data")).withColumn("_hash", F.xxhash64("_data"))


def removed_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, spans`` of the documents that lose bytes, one row a shard; spans may touch or overlap."""
    rows = keyed(docs.select("doc_id", "text")).select(F.col("_id").alias("doc_id"), F.col("_hash").alias("text_hash"), F.col("_data").alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    sample = [r[0] for r in rows.select(F.substring("data", 1, SAMPLE_CHARS)).limit(SAMPLE_ROWS).collect()]
    shards = max(16, math.ceil(total / STRINGS_PER_SHARD))
    routed = route(rows, gram_classes(sample), shards)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("spans", pa.list_(pa.int32()))])

    def scan(group: pa.Table) -> pa.Table:
        packed = group.column("packed")
        held = [p.as_buffer() for p in packed if p.is_valid]
        parts = group.filter(pa.compute.is_null(packed)).select(schema.names).cast(schema).to_batches()
        if held:
            found = scan_shard(held)
            parts.append(pa.RecordBatch.from_arrays(
                [pa.array(found["doc_id"]), pa.array(found["text_hash"]), found["spans"]], schema=schema))
        ids, hashes = (np.concatenate([p.column(k).to_numpy() for p in parts]) for k in (0, 1))
        sizes = np.concatenate([p.column(2).value_lengths().to_numpy() // 2 for p in parts])
        out = merged_columns(ids, hashes, sizes, np.concatenate([p.column(2).flatten().to_numpy() for p in parts]))
        hand_back()
        return pa.Table.from_arrays([pa.array(out["doc_id"]), pa.array(out["text_hash"]), out["spans"]], schema=schema)

    # a shard is a partition; it also gets the spans found on the way, and gives each span once
    return routed.repartitionById(shards, F.col("shard")).groupBy("shard").applyInArrow(scan, SPANS)


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of overlapping or touching spans, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.stack([spans[first, 0], reach[np.r_[first[1:], len(spans)] - 1]], 1)


def cut(data: bytes, spans: np.ndarray) -> bytes:
    keep, at = [], 0
    for begin, end in spans.tolist():
        keep.append(data[at:begin])
        at = end
    return b"".join([*keep, data[at:]])


def whole_characters(data: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans without the characters that are covered only in part."""
    out = []
    for begin, end in spans.tolist():
        while begin < end and data[begin] & 0xC0 == 0x80:
            begin += 1
        while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if begin < end:
            out.append((begin, end))
    return np.array(out, np.int64).reshape(-1, 2)


def with_spans(docs: DataFrame) -> DataFrame:
    """``_row, _data, _spans`` of each row, as in :func:`keyed`, with the spans found for it, each once (null: none)."""
    # a shard gives a document's spans once, however often the document repeats
    found = removed_spans(docs).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    spans = found.groupBy("_id", "_hash").agg(F.flatten(F.collect_list("spans")).alias("_spans"))
    return keyed(docs).join(spans, ["_id", "_hash"], "left").drop("_id", "_hash")


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""

    def make(batch: pa.RecordBatch) -> dict:
        out = []
        for data, found in zip(batch.column(1).to_pylist(), batch.column(2)):
            spans = found.values.to_numpy().reshape(-1, 2) if found.is_valid else np.zeros((0, 2), np.int32)
            spans = merged(spans) if len(spans) else spans
            kept = cut(data, spans)
            out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [()] * 4
        return {"doc_id": batch.column(0), **dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), columns))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(with_spans(docs.select("doc_id", "text")).select("_row.doc_id", "_data", "_spans"), make,
                     f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``; characters covered only in part stay."""

    def make(batch: pa.RecordBatch) -> dict:
        texts = []
        for data, found in zip(batch.column("_data").to_pylist(), batch.column("_spans")):
            if found.is_valid:
                data = cut(data, whole_characters(data, merged(found.values.to_numpy().reshape(-1, 2))))
            texts.append(data.decode("utf-8", "replace"))
        return {"_row": batch.column("_row"), "text": texts}

    rows = with_spans(docs)
    out = map_arrow(rows, make, T.StructType([rows.schema["_row"], T.StructField("text", T.StringType())]))
    return out.select("_row.*", "text").select(*[f"`{c}`" for c in docs.columns])
