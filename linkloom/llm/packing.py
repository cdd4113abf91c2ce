"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Texts are tokenized in the tasks; what is packed are pieces, whole documents or parts of longer ones. Pieces of
equal length are alike to the packer, so best-fit decreasing runs over the number of pieces of each length: at
most ``capacity`` numbers, at any input size. A segment tree over remaining capacities finds the tightest one
that open bins have, in logarithmic time, and runs of bins with the same remaining capacity move together. The
outcome is a short table of runs; pieces are numbered by length over the whole table and look up their run.

A null text is one piece that holds only the end id. Repeated rows are packed each. Other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import string
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_arrow, remembered, saved
from linkloom.operators.numbering import number_rows

CAPACITY = 2048
END_ID = 0
KNOWN_WORDS = 600_000
LONGEST_KNOWN = 64
TEXTS_AT_ONCE = 512
#: Signs that are never in one token with a letter beside them; an apostrophe may be, with the letter after it.
TAIL = string.punctuation
HEAD = TAIL.replace("'", "")
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"
_CODECS: dict[str, "Codec"] = remembered()


class Codec:
    """Ids of texts, by a tokenizer whose tokens never reach over a blank or a line break.

    The normalizer and the pre-tokenizer of such a tokenizer work on each word alone, so words are tokenized
    once and remembered, in a table that is emptied when full.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode_all = partial(self.tokenizer.encode_batch_fast, add_special_tokens=False)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = None  # whether an id ends a word, where the model marks that
        if suffix:
            ids = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(ids.values()) + 1, bool)
            self.ends[[i for token, i in ids.items() if token.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {"": b""}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > KNOWN_WORDS:
            self.known = {"": b""}
        split = [(text or "").replace("\n", " ").split(" ") for text in texts]
        get = self.known.get
        found = [list(map(get, words)) for words in split]
        gaps = [[at for at, ids in enumerate(parts) if ids is None] if None in parts else () for parts in found]
        long = self.learn({words[at] for words, missing in zip(split, gaps) for at in missing})
        for words, parts, missing in zip(split, found, gaps):
            for at in missing:
                parts[at] = get(words[at])
        for word in long:
            del self.known[word]
        return list(map(b"".join, found))

    def learn(self, words: set[str]) -> list[str]:
        """Put the ids of words into the table; returns those too long to stay there.

        Signs before and after letters are tokens of their own, so ``(word,`` is ``(`` and ``word`` and ``,``.
        """
        known, parts, whole, marked = self.known, set(), [], []
        for word in words:
            right = word.rstrip(TAIL)
            core = right.lstrip(HEAD)
            if not core.isalpha():
                whole.append(word)
                continue
            lower = core.lower() if core.isascii() else core
            if lower == word:
                parts.add(word)
                continue
            head, tail = right[:len(right) - len(core)], word[len(right):]
            parts.update((head, lower, tail))
            marked.append((word, head, lower, tail))
        found = self.plain({*parts.difference(known), *whole})
        known.update(found)
        known.update([(word, known[head] + known[core] + known[tail]) for word, head, core, tail in marked])
        return [word for word in {*words, *found} if len(word) > LONGEST_KNOWN]

    def plain(self, words: set[str]) -> dict[str, bytes]:
        """Words of letters alone are tokenized as one text and cut at the ids that end a word."""
        letters = [word for word in words if word.isalpha()] if self.ends is not None else []
        out = {}
        for at in range(0, len(letters), 1024):
            part = letters[at:at + 1024]
            ids = np.array(self.encode_all([" ".join(part)])[0].ids, "<u4")
            cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cuts) == len(part):
                data, stops = ids.tobytes(), cuts.tolist()
                out.update(zip(part, [data[b:e] for b, e in zip([0, *stops], stops)]))
        left = [word for word in words if word not in out]
        return out | {word: np.array(e.ids, "<u4").tobytes() for word, e in zip(left, self.encode_all(left))}


def without_gc(function, *args):
    """Call what makes many small objects but no cycles."""
    gc.disable()
    try:
        return function(*args)
    finally:
        gc.enable()


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each piece, with ``ids`` if wanted."""
    end, width = np.array([END_ID], "<u4").tobytes(), 4 * capacity

    def make(batch: pa.RecordBatch) -> dict:
        rows, taken = [], []
        for at, ids in enumerate(without_gc(codec(path).ids, batch.column(1).to_pylist())):
            ids += end
            for piece, begin in enumerate(range(0, len(ids), width)):
                part = ids[begin:begin + width]
                taken.append(at)
                rows.append((piece, begin // 4, len(part) // 4, zlib.crc32(part), part))
        piece, start, length, crc, part = zip(*rows)
        out = {"doc_id": batch.column(0).take(pa.array(taken)), "piece": piece, "start": start, "length": length,
               "ids_crc32": crc}
        return out | {"ids": [np.frombuffer(p, "<u4").astype(np.int32) for p in part]} if keep_ids else out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = PIECES.replace("doc_id long", f"doc_id {kind}") + (", ids array<int>" if keep_ids else "")
    return map_arrow(docs.select("doc_id", "text"), make, schema, TEXTS_AT_ONCE)


class OpenBins:
    """Open bins by remaining capacity, with a segment tree that finds the tightest fit."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def push(self, room: int, run: tuple[int, int]) -> None:
        if room and run[0] < run[1]:
            self.runs[room].append(run)
            self.mark(room)

    def pop(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self.mark(room)
        return run

    def mark(self, room: int) -> None:
        at = self.leaves + room
        self.any[at] = bool(self.runs[room])
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that takes ``length``."""
        at = self.leaves + length
        while not self.any[at]:
            while at & 1:
                at //= 2
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over ``length: pieces``, as runs ``first, per_bin, sequence, offset, length``.

    Pieces are numbered from 0, longest first. From the piece ``first`` on, every ``per_bin`` go into one bin,
    beginning with the bin ``sequence``, and stand there from ``offset`` on.
    """
    bins, at, opened, runs = OpenBins(capacity), 0, 0, []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                new = -(-left // (capacity // length))
                bins.push(capacity, (opened, opened + new))
                opened, room = opened + new, capacity
            begin, end = bins.pop(room)
            each = min(left, room // length)
            used = min(end - begin, left // each)
            runs.append((at, each, begin, capacity - room, length))
            at, left = at + used * each, left - used * each
            bins.push(room - each * length, (begin, begin + used))
            bins.push(room, (begin + used, end))
    return runs


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows of :func:`pieces` with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(counts, capacity)
    first, each, sequence, offset, length = (np.array(c, np.int64) for c in zip(*runs)) if runs else [np.zeros(0, int)] * 5
    names = found.columns
    order = [F.desc("length"), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    numbered = number_rows(found, order, "_number")

    def make(batch: pa.RecordBatch) -> dict:
        number = batch.column("_number").to_numpy() - 1
        run = np.searchsorted(first, number, "right") - 1
        within = number - first[run]
        return {**{c: batch.column(c) for c in names}, "sequence_id": sequence[run] + within // each[run],
                "offset": offset[run] + within % each[run] * length[run]}

    schema = found.schema.add("sequence_id", "long").add("offset", "long")
    return map_arrow(numbered, make, schema, 1 << 14)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its place: tokenized once, and written before it is numbered."""
    return place(saved(pieces(docs, path, capacity), "packing-pieces"), capacity)


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the packed sequences; none is longer than ``capacity``."""
    placed = place(saved(pieces(docs, path, capacity, keep_ids=True), "packing-ids"), capacity)
    whole = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))
    return whole.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
