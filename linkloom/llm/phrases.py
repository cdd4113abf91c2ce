"""Phrase collocations: contiguous word phrases scored against the parts they can be cut into, by counting quotient filters.

Texts are cut into pieces and words once and kept as streams of word numbers, a shard at a time. Words frequent enough
to stand in a candidate get ids; a shard is given the ids of its own words only. The ids of a phrase are packed into
one number, which a Feistel permutation maps one to one: its upper bits name a part of the filter and a quotient in it,
the rest is kept in full as the remainder. A filter is sorted, holds exact counts and loses nothing, so filters of
different shards are merged like sorted runs, part by part, and the ids come back from quotient and remainder.

Counts are kept per ``lang``; a null one is ``und``. A null text is empty. Repeated rows count each. Texts of any length
are read whole; a phrase never reaches from one text into another. Other columns are ignored, and an empty table has
no phrases.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import hand_back, saved
from linkloom.operators.numbering import number_rows

LEAST, LONGEST, TOP = 30, 4, 2000
SCALE = 2_000_000
COVERED = (100, 80)  # a longer phrase with at least 80 of 100 occurrences takes the shorter one's place
UNKNOWN_LANG = "und"
SHARD_BYTES = 1 << 22
FLUSH_WORDS = 1 << 21
PART_WORDS = 1 << 21
SPLIT_WORDS = 1 << 21
LIMB = 64
CUT, MARK = ".,;:!?\n\x0b\x0c\r", b"."
PIECES = bytes.maketrans(CUT.encode(), MARK * len(CUT))
STREAMS = "shard long, lang string, words array<string>, counts array<long>, stream binary"
BLOCKS = "lang string, n int, part long, entries long, filter binary"


def word_streams(docs: DataFrame) -> DataFrame:
    """``shard, lang, words, counts, stream``: for about ``SHARD_BYTES`` of text in one language its distinct words,
    how often each comes, and the text as their numbers, -1 between pieces."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
                        ("counts", pa.list_(pa.int64())), ("stream", pa.binary())])

    def packed(shard: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
        text = MARK.join(texts).lower().translate(PIECES).replace(MARK, b" . ")
        words = text.split()
        counts = Counter(words)
        counts.pop(MARK, None)
        number = {word: i for i, word in enumerate(counts)}
        number[MARK] = -1
        stream = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([lang]), pa.array([[w.decode() for w in counts]], schema.field("words").type),
             pa.array([list(counts.values())], schema.field("counts").type),
             pa.array([zstandard.compress(stream.tobytes(), 1)], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, []).append(text.as_py())
                sizes[lang] += len(held[lang][-1])
                if sizes[lang] >= SHARD_BYTES:
                    yield packed(shard, lang, held.pop(lang))
                    del sizes[lang]
                    shard += 1
        for lang, texts in held.items():
            yield packed(shard, lang, texts)
            shard += 1
        hand_back()

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, STREAMS)


def vocabulary(streams: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, word, f, id`` of words found ``least`` times or more, and ``lang, n``, all words of a language."""
    each = streams.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy("lang", F.col("words").alias("word"))
    counted = saved(each.agg(F.sum("counts").alias("f")), "phrases-words")
    often = number_rows(counted.filter(F.col("f") >= least), ["lang", "word"], "id")
    return saved(often.select("lang", "word", "f", "id"), "phrases-ids"), counted.groupBy("lang").agg(F.sum("f").alias("n"))


class Packing:
    """Packs the ids of an ``n``-word phrase into a number of ``2 * half`` bits and permutes it one to one.

    A number is a pair of halves; up to ``LIMB`` bits in all, sorting takes one array of them, else two.
    """

    ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

    def __init__(self, n: int, id_bits: int):
        self.n, self.id_bits = n, id_bits
        self.half = (n + 1) // 2 * id_bits
        if self.half > LIMB:
            raise ValueError("word ids of more than 32 bits")
        self.mask = np.uint64((1 << self.half) - 1)
        self.bits = 2 * self.half

    def mixed(self, values: np.ndarray, factor: int) -> np.ndarray:
        out = (values + np.uint64(1)) * np.uint64(factor)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return (out >> np.uint64(64 - self.half)) & self.mask

    def permuted(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the permuted number of each phrase, whose words come as one array for each place."""
        cut = (self.n + 1) // 2
        high, low = self.joined(words[:cut]), self.joined(words[cut:])
        for factor in self.ROUNDS:
            high, low = low, high ^ self.mixed(low, factor)
        return high, low

    def joined(self, words: list[np.ndarray]) -> np.ndarray:
        out = words[0].astype(np.uint64)
        for word in words[1:]:
            out = out << np.uint64(self.id_bits) | word.astype(np.uint64)
        return out

    def words(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        """Back from permuted numbers to the ids."""
        for factor in reversed(self.ROUNDS):
            high, low = low ^ self.mixed(high, factor), high
        cut = (self.n + 1) // 2
        return self.parted(high, cut) + self.parted(low, self.n - cut)

    def parted(self, values: np.ndarray, n: int) -> list[np.ndarray]:
        mask = np.uint64((1 << self.id_bits) - 1)
        return [values >> np.uint64(self.id_bits * k) & mask for k in range(n - 1, -1, -1)]


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, half: int) -> tuple[np.ndarray, ...]:
    """Distinct numbers in order, as halves, with their counts summed."""
    if 2 * half <= LIMB:
        whole = high << np.uint64(half) | low
        if counts is None:
            whole.sort()
        else:
            order = np.argsort(whole, kind="stable")  # merges the sorted runs
            whole, counts = whole[order], counts[order]
        first = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]]) if len(whole) else np.zeros(0, np.int64)
        high, low = whole[first] >> np.uint64(half), whole[first] & np.uint64((1 << half) - 1)
        total = len(whole)
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        counts = None if counts is None else counts[order]
        first = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) \
            if len(high) else np.zeros(0, np.int64)
        total = len(high)
        high, low = high[first], low[first]
    sums = np.diff(np.r_[first, total]) if counts is None else (
        np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64))
    return high, low, sums.astype(np.int64)


class QuotientFilter:
    """Counts of permuted numbers in one part of their range, in quotient and remainder form.

    The part is the uppermost ``part_bits`` of the upper half. The next ``quotient_bits`` choose a run; run lengths are
    written in unary, a one for each entry and a zero at the run's end. Remainders are written in full, byte by byte
    of equal weight; counts take one byte, and larger ones follow on their own.
    """

    HEAD = struct.Struct("<QBB")

    def __init__(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray, half: int, part_bits: int, part: int):
        self.high, self.low, self.counts = high, low, counts
        self.half, self.part_bits, self.part = half, part_bits, part

    def packed(self) -> bytes:
        n = len(self.counts)
        quotient_bits = min(self.half - self.part_bits, max(0, n.bit_length() - 1))
        rest_bits = self.half - self.part_bits - quotient_bits
        rest = self.high & np.uint64((1 << (self.half - self.part_bits)) - 1)
        quotient = (rest >> np.uint64(rest_bits)).astype(np.int64) if rest_bits < 64 else np.zeros(n, np.int64)
        unary = np.zeros(n + (1 << quotient_bits), np.uint8)
        unary[quotient + np.arange(n)] = 1
        rest = rest & np.uint64((1 << rest_bits) - 1)
        small = np.minimum(self.counts, 255).astype(np.uint8)
        parts = [self.HEAD.pack(n, quotient_bits, self.part_bits), np.packbits(unary).tobytes(),
                 self.planes(rest, rest_bits), self.planes(self.low, self.half), small.tobytes(),
                 self.counts[self.counts >= 255].tobytes()]
        return zstandard.compress(b"".join(parts), 1)

    @staticmethod
    def planes(values: np.ndarray, bits: int) -> bytes:
        width = -(-bits // 8)
        return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()

    @classmethod
    def read(cls, packed: bytes, half: int, part: int) -> QuotientFilter:
        raw = zstandard.decompress(packed)
        n, quotient_bits, part_bits = cls.HEAD.unpack_from(raw)
        at, slots = cls.HEAD.size, n + (1 << quotient_bits)
        unary = np.unpackbits(np.frombuffer(raw, np.uint8, -(-slots // 8), at), count=slots)
        at += -(-slots // 8)
        quotient = (np.flatnonzero(unary) - np.arange(n)).astype(np.uint64)
        rest_bits = half - part_bits - quotient_bits
        columns = []
        for bits in (rest_bits, half):
            width = -(-bits // 8)
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
            columns.append(wide.view("<u8").ravel())
            at += n * width
        high = columns[0] | (quotient << np.uint64(rest_bits) if rest_bits < 64 else np.uint64(0))
        if part_bits:
            high |= np.uint64(part << (half - part_bits))
        counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
        counts[counts == 255] = np.frombuffer(raw, np.int64, offset=at + n)
        return cls(high, columns[1], counts, half, part_bits, part)

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """The sum of filters of one part."""
        one = filters[0]
        high, low, counts = (np.concatenate([getattr(f, c) for f in filters]) for c in ("high", "low", "counts"))
        return cls(*counted(high, low, counts, one.half), one.half, one.part_bits, one.part)


def phrase_filters(ids: np.ndarray, n: int, id_bits: int, part_bits: int) -> Iterator[QuotientFilter]:
    """Filters, one for each part, of the phrases of ``n`` words in a stream of ids; an id of 0 ends a phrase."""
    known = ids > 0
    whole = known[:len(ids) - n + 1].copy() if len(ids) >= n else known[:0]
    for k in range(1, n):
        whole &= known[k:len(ids) - n + 1 + k]
    at = np.flatnonzero(whole)
    if not len(at):
        return
    packing = Packing(n, id_bits)
    high, low, counts = counted(*packing.permuted([ids[at + k] for k in range(n)]), None, packing.half)
    bits = min(part_bits, packing.half)
    parts = (high >> np.uint64(packing.half - bits)).astype(np.int64) if bits else np.zeros(len(high), np.int64)
    cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield QuotientFilter(high[a:b], low[a:b], counts[a:b], packing.half, bits, int(parts[a]))


def shard_filters(streams: DataFrame, words: DataFrame, longest: int, id_bits: int, n_words: int) -> DataFrame:
    """``lang, n, part, entries, filter``: the phrases of 2 to ``longest`` words of each shard, or of a few together."""
    width = max(8, -(-n_words // SPLIT_WORDS))
    part_bits = max(0, (n_words // PART_WORDS).bit_length())
    named = streams.select("shard", "lang", F.posexplode("words").alias("pos", "word")).join(
        words.select("lang", "word", "id"), ["lang", "word"])
    # no longer than the distinct words of a shard
    own = named.groupBy("shard", "lang").agg(F.collect_list(F.struct("pos", "id")).alias("known"))
    rows = streams.select("shard", "lang", F.size("words").alias("size"), "stream").repartition(
        width, "shard", "lang").join(own.repartition(width, "shard", "lang"), ["shard", "lang"])
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("part", pa.int64()), ("entries", pa.int64()),
                        ("filter", pa.binary())])

    def blocks(lang: str, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(held)
        held.clear()
        for n in range(2, longest + 1):
            found = [(lang, n, f.part, len(f.counts), f.packed()) for f in phrase_filters(ids, n, id_bits, part_bits)]
            for at in range(0, len(found), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found[at:at + 64]), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        sizes: Counter = Counter()
        for batch in batches:
            for row in range(batch.num_rows):
                lang, size = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                known = batch.column(3)[row].values
                table = np.zeros(size + 1, np.int64)  # the last place is for -1
                table[known.field("pos").to_numpy()] = known.field("id").to_numpy()
                stream = np.frombuffer(zstandard.decompress(batch.column(2)[row].as_buffer()), np.int32)
                held.setdefault(lang, []).extend([table[stream], np.zeros(1, np.int64)])
                sizes[lang] += len(stream)
                if sum(sizes.values()) >= FLUSH_WORDS:
                    for name in list(held):
                        yield from blocks(name, held.pop(name))
                    sizes.clear()
        for name in list(held):
            yield from blocks(name, held.pop(name))
        hand_back()

    return rows.select("lang", "size", "stream", "known").mapInArrow(run, BLOCKS)


def frequent_phrases(filters: DataFrame, id_bits: int, least: int, width: int) -> DataFrame:
    """``lang, ids, a``: the filters of all shards merged, and the phrases found ``least`` times or more."""
    schema = pa.schema([("lang", pa.string()), ("ids", pa.list_(pa.int64())), ("a", pa.int64())])

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        lang, n, part = (k.as_py() for k in key)
        packing = Packing(n, id_bits)
        whole = QuotientFilter.merged([QuotientFilter.read(b.as_buffer(), packing.half, part) for b in group.column("filter")])
        often = whole.counts >= least
        words = np.stack(packing.words(whole.high[often], whole.low[often]), 1).astype(np.int64)
        counts = whole.counts[often]
        offsets = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * n)
        hand_back()
        return pa.Table.from_arrays(
            [pa.array([lang] * len(counts), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(words.ravel())),
             pa.array(counts)], schema=schema)

    return filters.repartition(width, "lang", "n", "part").groupBy("lang", "n", "part").applyInArrow(
        merge, "lang string, ids array<long>, a long")


def wide(column: str):
    """Products of counts pass 64 bits."""
    return F.col(column).cast("decimal(20,0)")


def not_covered(found: DataFrame) -> DataFrame:
    """Phrases without those that stand inside a longer one with nearly as many occurrences."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("ids") - n + 1), lambda at: F.slice("ids", at, n))))
    inside = found.filter(F.size("ids") > 2).select("lang", "a", F.explode(F.array_distinct(spans)).alias("ids"))
    most = inside.groupBy("lang", "ids").agg(F.max("a").alias("most"))
    rows = found.join(most, ["lang", "ids"], "left")
    covered = F.lit(COVERED[0]) * wide("most") >= F.lit(COVERED[1]) * wide("a")
    return rows.filter(F.col("most").isNull() | ~covered).drop("most")


def scored(kept: DataFrame, found: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, ids, a, l, r, score`` of each phrase at its lowest-scoring cut."""
    parts = words.select("lang", F.array("id").alias("part"), "f").union(
        found.select("lang", "ids", "a"))
    cuts = kept.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("slice(ids, 1, k)").alias("first"), F.expr("slice(ids, k + 1, size(ids))").alias("rest"))
    for end, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.toDF("lang", end, name), ["lang", end])
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + r)"))
    lowest = cuts.groupBy("lang", "ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "ids", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 id_bits: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language.

    A phrase has 2 to ``longest`` words and ``least`` occurrences. Phrases go by score and occurrences, falling, and
    by their text.
    """
    streams = saved(word_streams(docs), "phrases-streams")
    words, totals = vocabulary(streams, least)
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    bits = id_bits or max(1, words.count().bit_length())
    filters = shard_filters(streams, words, longest, bits, n_words)
    found = saved(frequent_phrases(filters, bits, least, max(8, (longest - 1) * n_words // PART_WORDS)), "phrases-found")
    rated = saved(scored(not_covered(found), found, words), "phrases-scored")
    # the cut keeps whole ties, since their order is known only from the words
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = rated.withColumn("place", F.rank().over(order)).filter(F.col("place") <= top).drop("place")
    each = best.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    named = each.groupBy("lang", "ids").agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ")
                                            .alias("phrase"))
    rows = best.join(named, ["lang", "ids"]).join(totals, "lang")
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(last).cast("long")).filter(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
