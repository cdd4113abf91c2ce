"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own embedding, if the training sample has it often enough, and as the mean embedding of its
character grams. What a word adds to the gates is computed once and remembered. The network reads windows of
``WINDOW`` words that overlap by ``WINDOW - STRIDE``; the score of a text is that of its highest window, and all
windows of the whole text count. A text without words has one empty window.

Training is on the driver, on a bounded sample of labelled rows (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``, by a
hash of the id). A label is of a text, not a window, so each epoch a text trains by its highest window and, if
it is clean, by some others. Null texts are empty; null labels are not used; rows repeated are scored each.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_arrow, remembered

WINDOW, STRIDE = 48, 32
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 2500
THRESHOLD = 0.3
HIDDEN, WORD_SIZE, GRAM_SIZE, ATTENTION = 8, 8, 8, 8
BUCKETS = 1 << 13
LEAST_DOCS, MOST_WORDS = 3, 20_000
EPOCHS, BATCH, RATE, DECAY = 10, 64, 0.01, 0.02
KNOWN_WORDS = 120_000
WINDOWS_AT_ONCE = 1024
WORD = re.compile(r"\w+")
_TABLES: dict[str, "Table"] = remembered()


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character grams of words with their ends marked, and where each word's grams begin.

    Grams of three and of five signs have buckets of their own.
    """
    text = "".join([f"^{word}$" for word in words])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    begins = ends - sizes
    end_of = np.repeat(ends, sizes)
    places = np.arange(len(points))
    parts, owners = [], []
    for kind, n in enumerate((3, 5)):
        code = np.zeros(len(points), np.uint64)
        for k in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + np.r_[points[k:], np.zeros(k, np.uint64)]
        code ^= code >> np.uint64(31)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        fits = np.flatnonzero(places + n <= end_of)
        parts.append((code[fits] >> np.uint64(51)).astype(np.int64) % BUCKETS + kind * BUCKETS)
        owners.append(np.searchsorted(begins, fits, "right") - 1)
    owner, bucket = np.concatenate(owners), np.concatenate(parts)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(words)))


def window_starts(n: int) -> range | list[int]:
    """Starts of windows that overlap and cover ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    words: dict[str, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(words: list[str], seed: int = 7) -> "Network":
        r, h, size = np.random.default_rng(seed), HIDDEN, WORD_SIZE + GRAM_SIZE

        def normal(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": normal(len(words) + 1, WORD_SIZE, scale=0.1), "gram": normal(2 * BUCKETS, GRAM_SIZE, scale=0.1)}
        for d in "fb":
            p["in" + d] = normal(size, 3 * h, scale=size ** -0.5)
            p["bias" + d] = np.zeros(3 * h, np.float32)
            p["gate" + d] = normal(h, 2 * h, scale=h ** -0.5)
            p["new" + d] = normal(h, h, scale=h ** -0.5)
        p |= {"att": normal(2 * h, ATTENTION, scale=h ** -0.5), "attb": np.zeros(ATTENTION, np.float32),
              "attv": normal(ATTENTION, scale=0.5), "out": normal(2 * h, scale=0.5), "outb": np.zeros(1, np.float32)}
        p["word"][0] = 0
        return Network({word: i + 1 for i, word in enumerate(words)}, p)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """The input of each word, and what it was made of."""
        own = np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))
        bucket, first = gram_rows(words)
        count = np.diff(np.r_[first, len(bucket)]).astype(np.float32)[:, None]
        grams = np.add.reduceat(self.p["gram"][bucket], first) / count * 3
        return np.concatenate([self.p["word"][own], grams], 1), (own, bucket, first, count)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What words add to the gates: of both directions, and zeros as the last row, for places without a word."""
        added = np.concatenate([x @ self.p["in" + d] + self.p["bias" + d] for d in "fb"], 1)
        return np.concatenate([added, np.zeros((1, added.shape[1]), np.float32)]).astype(np.float32)

    def run(self, gates: np.ndarray, index: np.ndarray, keep: bool = False):
        """Logits of windows, ``index`` holding rows of ``gates`` by place and window, -1 where no word is."""
        p, h = self.p, HIDDEN
        steps, n = index.shape
        here = (index >= 0).astype(np.float32)[:, :, None]
        states = np.zeros((steps, n, 2 * h), np.float32)
        trace = {"f": [], "b": []}
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            side = slice(0, h) if d == "f" else slice(h, 2 * h)
            a = gates[index, (0 if d == "f" else 3 * h):(3 * h if d == "f" else 6 * h)]
            state, full = np.zeros((n, h), np.float32), bool((index >= 0).all())
            for t in order:
                zr = sigmoid(a[t, :, :2 * h] + state @ p["gate" + d])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(a[t, :, 2 * h:] + (r * state) @ p["new" + d])
                new = state + z * (c - state)
                if not full:
                    new *= here[t]
                if keep:
                    trace[d].append((t, state, zr, c))
                state = new
                states[t, :, side] = new
        u = np.tanh(states @ p["att"] + p["attb"])
        score = np.where(here[:, :, 0] > 0, u @ p["attv"], np.float32(-1e9))
        weight = np.exp(score - score.max(0)) * here[:, :, 0]
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tnk->nk", weight, states)
        logit = pooled @ p["out"] + p["outb"][0]
        return (logit, (a, here, states, trace, u, weight, pooled)) if keep else logit

    def gradients(self, gates: np.ndarray, index: np.ndarray, labels: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean log loss by parameter, and by row of ``gates``."""
        p, h = self.p, HIDDEN
        logit, (_, here, states, trace, u, weight, pooled) = self.run(gates, index, keep=True)
        d_logit = ((sigmoid(logit) - labels) / len(labels)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "outb": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled[None]
        d_weight = np.einsum("nk,tnk->tn", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["attv"] = np.einsum("tn,tna->a", d_score, u)
        d_u = d_score[:, :, None] * p["attv"] * (1 - u * u)
        g["att"] = np.einsum("tnk,tna->ka", states, d_u)
        g["attb"] = d_u.sum((0, 1))
        d_states += d_u @ p["att"].T
        d_gates = np.zeros((*index.shape, 6 * h), np.float32)
        for d, at in (("f", 0), ("b", 3 * h)):
            side = slice(0, h) if d == "f" else slice(h, 2 * h)
            g["gate" + d], g["new" + d] = np.zeros_like(p["gate" + d]), np.zeros_like(p["new" + d])
            carry = np.zeros((index.shape[1], h), np.float32)
            for t, state, zr, c in reversed(trace[d]):
                z, r = zr[:, :h], zr[:, h:]
                delta = (d_states[t, :, side] + carry) * here[t]
                d_c = delta * z * (1 - c * c)
                d_rs = d_c @ p["new" + d].T
                d_zr = np.concatenate([delta * (c - state), d_rs * state], 1) * zr * (1 - zr)
                g["new" + d] += (r * state).T @ d_c
                g["gate" + d] += state.T @ d_zr
                carry = delta * (1 - z) + d_rs * r + d_zr @ p["gate" + d].T
                d_gates[t, :, at:at + 3 * h] = np.concatenate([d_zr, d_c], 1)
        by_row = np.zeros_like(gates)
        np.add.at(by_row, index.ravel(), d_gates.reshape(-1, 6 * h))
        return g, by_row[:-1]

    def backward_inputs(self, x: np.ndarray, made: tuple, d_gates: np.ndarray, g: dict) -> None:
        own, bucket, first, count = made
        d_x = np.zeros_like(x)
        for d, at in (("f", 0), ("b", 3 * HIDDEN)):
            part = d_gates[:, at:at + 3 * HIDDEN]
            g["in" + d], g["bias" + d] = x.T @ part, part.sum(0)
            d_x += part @ self.p["in" + d].T
        g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
        np.add.at(g["word"], own, d_x[:, :WORD_SIZE])
        g["word"][0] = 0
        each = np.repeat(d_x[:, WORD_SIZE:] / count * 3, np.diff(np.r_[first, len(bucket)]), axis=0)
        np.add.at(g["gram"], bucket, each)


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = RATE):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, 1.0 / (size + 1e-9))
        for k, x in g.items():
            x = x * scale
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            fixed = self.m[k] / (1 - 0.9 ** self.t)
            self.p[k] -= self.rate * (fixed / (np.sqrt(self.v[k] / (1 - 0.99 ** self.t)) + 1e-6) + DECAY * self.p[k])


def window_index(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of texts given as row numbers of words: ``text, start, words in the window``."""
    texts, starts = [], []
    for at, own in enumerate(ids):
        found = window_starts(len(own))
        starts += found
        texts += [at] * len(found)
    text, start = np.array(texts, np.int64), np.array(starts, np.int64)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return text, start, np.minimum(WINDOW, sizes[text])


def window_rows(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """By place and window: row numbers of the words, -1 after the last."""
    steps = max(1, int(sizes.max(initial=1)))
    place = np.arange(steps)[:, None]
    inside = place < sizes[None, :]
    return np.where(inside, np.r_[flat, -1][np.where(inside, begins[None, :] + place, len(flat))], -1)


def window_logits(net: Network, gates: np.ndarray, ids: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """``text, start, size, logit`` of every window."""
    text, start, size = window_index(ids)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    begins = (np.cumsum(lengths) - lengths)[text] + start
    logit = np.zeros(len(text), np.float32)
    order = np.argsort(size, kind="stable")
    for at in range(0, len(order), WINDOWS_AT_ONCE):
        part = order[at:at + WINDOWS_AT_ONCE]
        logit[part] = net.run(gates, window_rows(flat, begins[part], size[part]))
    return text, start, size, logit


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """A network fitted to labelled texts."""
    label = np.array(labels, np.float32)
    row_of: dict[str, int] = {}
    ids = []
    for text in texts:
        own = words_of(text)
        ids.append(np.fromiter((row_of.setdefault(w, len(row_of)) for w in own), np.int32, len(own)))
    vocabulary, seen = list(row_of), np.zeros((len(row_of), 2), np.int64)
    for own, toxic in zip(ids, labels):
        seen[np.unique(own), int(toxic)] += 1
    order = sorted(np.flatnonzero(seen.sum(1) >= LEAST_DOCS).tolist(), key=lambda i: (-seen[i].sum(), vocabulary[i]))
    net = Network.fresh([vocabulary[i] for i in order[:MOST_WORDS]], seed)
    if not vocabulary or not len(label):
        return net
    clean, toxic = max(1, int((label == 0).sum())), max(1, int(label.sum()))
    # the first choice of windows goes by how much oftener a word is in toxic texts
    odds = np.log((seen[:, 1] + 0.2) / toxic) - np.log((seen[:, 0] + 0.2) / clean)
    odds = np.maximum(0, odds - 1) * np.minimum(1, seen.sum(1) / 4)
    text, start, size = window_index(ids)
    first = np.array([odds[ids[t][s:s + n]].sum() for t, s, n in zip(text, start, size)], np.float32)
    flat = np.concatenate(ids)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    begins = (np.cumsum(lengths) - lengths)[text] + start
    adam, r = Adam(net.p), np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        if epoch in (0, 1):
            value = first
        elif epoch % 2 == 0:
            value = window_logits(net, net.gates(net.inputs(vocabulary)[0]), ids)[3]
        order = np.lexsort((-value, text))
        best = order[np.r_[True, text[order][1:] != text[order][:-1]]]
        other = np.flatnonzero((label[text] == 0) & (r.random(len(text)) < 0.1))
        chosen = np.unique(np.concatenate([best, other]))
        r.shuffle(chosen)
        adam.rate = RATE * (1 if epoch < EPOCHS * 2 // 3 else 0.3)
        for at in range(0, len(chosen), BATCH):
            part = chosen[at:at + BATCH]
            rows = window_rows(flat, begins[part], size[part])
            used, local = np.unique(rows[rows >= 0], return_inverse=True)
            index = np.full(rows.shape, -1)
            index[rows >= 0] = local
            if not len(used):
                continue
            x, made = net.inputs([vocabulary[i] for i in used])
            g, d_gates = net.gradients(net.gates(x), index, label[text[part]])
            net.backward_inputs(x, made, d_gates, g)
            adam.step(g)
    return net


class Table:
    """What words add to the gates, computed once for each word a worker meets; emptied when full."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.gates = np.zeros((0, 6 * HIDDEN), np.float32)

    def ids(self, split: list[list[str]]) -> list[np.ndarray]:
        new = list(set().union(*split).difference(self.rows))
        if len(self.rows) + len(new) > KNOWN_WORDS and self.rows:
            self.clear()
            new = list(set().union(*split))
        if new:
            added = self.net.gates(self.net.inputs(new)[0])[:-1]
            self.rows.update(zip(new, range(len(self.gates), len(self.gates) + len(new))))
            self.gates = np.concatenate([self.gates, added])
        get = self.rows.__getitem__
        return [np.fromiter(map(get, own), np.int64, len(own)) for own in split]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text: of its highest window."""
        ids = self.ids([words_of(t) for t in texts])
        gates = np.concatenate([self.gates, np.zeros((1, 6 * HIDDEN), np.float32)])
        text, _, _, logit = window_logits(self.net, gates, ids)
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, text, logit)
        return sigmoid(top.astype(np.float64))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Network:
    """A network trained on at most ``toxic`` and ``clean`` labelled rows that are not held out."""
    usable = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.filter("toxic = 1").orderBy(*by_hash).limit(toxic).union(
        usable.filter("toxic = 0").orderBy(*by_hash).limit(clean))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most the sample
    found = rows.orderBy("doc_id", "text").limit(2 * (toxic + clean)).collect()
    return train([r["text"] or "" for r in found], [r["toxic"] for r in found])


def scored(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """``docs`` with the score of the whole ``text``."""
    names = docs.columns
    key = f"{zlib.crc32(b''.join(v.tobytes() for v in net.p.values()))}-{len(net.words)}"

    def make(batch: pa.RecordBatch) -> dict:
        table = _TABLES.get(key)
        if table is None:
            _TABLES.clear()
            table = _TABLES[key] = Table(net)
        return {**{c: batch.column(c) for c in names if c != name},
                name: table.scores(batch.column("text").to_pylist())}

    from pyspark.sql import types as T

    schema = T.StructType([f for f in docs.schema if f.name != name]).add(name, "double")
    return map_arrow(docs, make, schema, 512)
