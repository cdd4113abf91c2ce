"""Encoding and decoding with the pieces of a SentencePiece model, by streaming Viterbi.

The best segmentation is the one with the highest sum of piece scores; a character without a piece costs more
than any piece and becomes byte pieces. The text is read once from the left. Only the scores of the last
positions, as many as the longest piece, are alive, and whenever the backpointers of all of them run through
one boundary, the ids before it are final and handed out.

If no piece has a word mark after another character, every word mark that follows one is such a boundary, so
words are encoded alone and remembered in a table that is emptied when full.

The text gets a leading word mark and its blanks become word marks, as the model says. Null and empty texts
have no ids. Decoding turns word marks back into blanks; a text that holds the mark itself does not come back.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkloom.llm.common import map_arrow, remembered

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN_WORDS = 1_000_000
LONGEST_KNOWN = 64
CHUNK = 256
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
_MODELS: dict[str, "Pieces"] = remembered()


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.names = [p.piece for p in model.pieces]
        self.table = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.root: dict = {}  # by character: the next characters, and under "" the score and id of a piece
        for name, found in self.table.items():
            node = self.root
            for sign in name:
                node = node.setdefault(sign, {})
            node[""] = found
        self.longest = max(map(len, self.table))
        self.unknown_score = min(score for score, _ in self.table.values()) - UNKNOWN_PENALTY
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == 2), 0)
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.first_byte, self.last_byte = min(self.bytes_of, default=0), max(self.bytes_of, default=0)
        self.by_word = not any(MARK in name.lstrip(MARK) for name in self.table)
        self.known: dict[str, bytes] = {}

    def stream(self, chunks: Iterable[str]) -> Iterator[list[int]]:
        """Final ids, as soon as they are, of the text that the chunks make up."""
        return self.steps(marked_last(chunks))

    def steps(self, chunks: Iterable[tuple[str, bool]]) -> Iterator[list[int]]:
        """The same of chunks that say whether they are the last."""
        table, root, longest, unknown = self.table, self.root, self.longest, self.unknown_score
        # index 0 of the lists is the last committed boundary, where one state is left
        text, at, reach, best, back, piece = "", 0, 0, [0.0], [0], [0]
        for chunk, last in chunks:
            text += chunk
            room = len(text) + 1 - len(best)
            best += [None] * room
            back += [0] * room
            piece += [0] * room
            while at < len(text) and (last or at + longest <= len(text)):
                score = best[at]
                if score is not None:
                    node, end = root, at
                    for sign in text[at:at + longest]:
                        node = node.get(sign)
                        if node is None:
                            break
                        end += 1
                        found = node.get("")
                        if found is not None:
                            total = score + found[0]
                            if best[end] is None or total > best[end]:
                                best[end], back[end], piece[end] = total, at, found[1]
                                if end > reach:
                                    reach = end
                    if text[at] not in table and (best[at + 1] is None or score + unknown > best[at + 1]):
                        best[at + 1], back[at + 1], piece[at + 1] = score + unknown, at, -1
                        reach = max(reach, at + 1)
                at += 1
                if reach == at:  # one live position
                    boundary = at
                elif at % longest == 0:
                    boundary = self.boundary([k for k in range(at, reach + 1) if best[k] is not None], back)
                else:
                    continue
                if boundary and at < len(text):
                    yield self.collect(text, boundary, back, piece)
                    text, at, reach = text[boundary:], at - boundary, reach - boundary
                    best, piece = best[boundary:], piece[boundary:]
                    back = [max(0, k - boundary) for k in back[boundary:]]
            if last and text:
                yield self.collect(text, len(text), back, piece)

    @staticmethod
    def boundary(live: list[int], back: list[int]) -> int:
        """The last position that the backpointers of all live positions run through."""
        while len(live) > 1:
            live = sorted({*live[:-1], back[live[-1]]})
        return live[0]

    def collect(self, text: str, boundary: int, back: list[int], piece: list[int]) -> list[int]:
        parts, at = [], boundary
        while at > 0:
            if piece[at] >= 0:
                parts.append((piece[at],))
            else:
                parts.append([self.byte_ids.get(b, self.unknown) for b in text[back[at]:at].encode()])
            at = back[at]
        return [i for part in reversed(parts) for i in part]

    def encode_word(self, word: str) -> bytes:
        if len(word) <= CHUNK:
            chunks = ((word, True),)
        else:
            chunks = ((word[k:k + CHUNK], k + CHUNK >= len(word)) for k in range(0, len(word), CHUNK))
        ids = []
        for part in self.steps(chunks):
            ids += part
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if not self.by_word:
            return self.encode_word(MARK + text.replace(" ", MARK))
        words = text.replace(MARK, " ").split(" ")
        if "" in words:  # runs of blanks belong to the word after them
            words = [part[1:] for part in re.findall(" +[^ ]*", " " + " ".join(words))]
        parts = list(map(self.known.get, words))
        if None in parts:
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            for i in [i for i, ids in enumerate(parts) if ids is None]:
                word = words[i]
                parts[i] = ids = self.encode_word(MARK + word.replace(" ", MARK))
                if len(word) <= LONGEST_KNOWN:
                    self.known[word] = ids
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        if not len(self.bytes_of) or not ((numbers >= self.first_byte) & (numbers <= self.last_byte)).any():
            return "".join([self.names[i] for i in numbers.tolist()])[1:].replace(MARK, " ")
        out, raw = [], bytearray()
        for i in [*numbers.tolist(), None]:
            if i in self.bytes_of:
                raw.append(self.bytes_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append("" if i is None else self.names[i])
        return "".join(out)[1:].replace(MARK, " ")


def marked_last(chunks: Iterable[str]) -> Iterator[tuple[str, bool]]:
    held = None
    for chunk in chunks:
        if held is not None:
            yield held, False
        held = chunk
    if held is not None:
        yield held, True


def pieces(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> dict:
        model = pieces(path)
        return {"doc_id": batch.column(0),
                "ids": [np.frombuffer(model.encode(t), "<u4").astype(np.int32) for t in batch.column(1).to_pylist()]}

    return map_arrow(docs.select("doc_id", "text"), make, f"doc_id {kind}, ids array<int>", 256)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of every row of :func:`encoded`."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> dict:
        model = pieces(path)
        texts = [model.decode(np.array(ids, "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "text": texts}

    return map_arrow(rows.select("doc_id", "ids"), make, f"doc_id {kind}, text string", 256)


def summary(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_chars, n_ids, ids_crc32, round_trip``: every text encoded, and whether decoding brings it back."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> dict:
        model, texts = pieces(path), [t or "" for t in batch.column(1).to_pylist()]
        ids = [model.encode(t) for t in texts]
        return {"doc_id": batch.column(0), "n_chars": [len(t) for t in texts], "n_ids": [len(i) // 4 for i in ids],
                "ids_crc32": [zlib.crc32(i) for i in ids],
                "round_trip": [model.decode(i) == t for i, t in zip(ids, texts)]}

    return map_arrow(docs.select("doc_id", "text"), make,
                     f"doc_id {kind}, n_chars long, n_ids long, ids_crc32 long, round_trip boolean", 256)
