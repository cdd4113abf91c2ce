"""Line dedup, structure repair and phrases against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import catalog, lines, phrases, repair
from linkloom.llm.common import table, unused

WHITE = " \t\n\x0b\f\r"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2)], "Keep int, _keep int")
    assert unused(df, "keep", "other", "other") == ["__keep", "other", "_other"]


# lines


@pytest.fixture(scope="module")
def line_rows():
    r = random.Random(1)
    pool = ["  Shared LINE number %d\t" % k for k in range(12)] + ["shared line number 3", "short", "ÉÀ ein paar Wörter", ""]
    rows = [(k, "\n".join(r.choices(pool + ["own line of document %d" % k], k=r.randint(1, 9)))) for k in range(60)]
    long = "\n".join(f"line {k} of a very long text" for k in range(5000))
    return rows + [(None, "shared line number 3"), (None, long), (7, rows[7][1]), (7, "another text of 7\nshared line number 5"),
                   (100, None), (101, ""), (102, long), (103, long + "\n"), (-5, "Shared Line Number 11\r\n\n")]


def brute_lines(rows, least=10):
    def key(line):
        line = line.strip(WHITE)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            at = 1 << 63 if i is None else i
            first[key(line)] = min(first.get(key(line), at), at)
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(key(x)) < least or first[key(x)] >= (1 << 63 if i is None else i)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("how", [{}, {"run_rows": 3}, {"run_rows": 3, "ranges": 40}, {"run_rows": 1 << 30, "ranges": 3}])
def test_lines_against_brute_force(spark, line_rows, how):
    docs = spark.createDataFrame(line_rows, "doc_id long, text string").repartition(5)
    want = brute_lines(line_rows)
    kept = lines.keep_bitmaps(docs, **how)
    assert kept.columns == ["doc_id", "n_lines", "n_dropped", "runs"]
    assert Counter((r[0], r[1], r[2]) for r in kept.collect()) == Counter(row[:3] for row in want)
    wide = docs.select("doc_id", "text", F.lit("d").alias("dropped"), F.lit(5).alias("id"), F.lit(None).cast("long").alias("h1"),
                       F.lit("k").alias("keep"), F.lit(1).alias("Text_Hash"))
    out = lines.deduplicated(wide, **how)
    assert out.columns == wide.columns
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"] or "") for r in rows) == Counter((i, text) for i, _, _, text in want)
    assert {(r["dropped"], r["id"], r["h1"], r["keep"], r["Text_Hash"]) for r in rows} == {("d", 5, None, "k", 1)}


def test_lines_use_no_python(spark, folder):
    plan = catalog.op11_lines(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lines_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lines.keep_bitmaps(none).collect() == [] and lines.deduplicated(none).collect() == []


# repair


def brute_repair(turns):
    """From rows in order: everything the query returns, by a plain search over grammar states."""
    seen, faults, kinds, extra, last, illegal = set(), Counter(), [], [], None, 0
    for role, text in turns:
        if last is not None and last + role[:1] not in ("su", "ua", "au"):
            illegal += 1
        last = role[:1]
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        kinds.append(None if fault in ("blank", "duplicate") else role[:1])
        extra.append(5 * (fault == "truncated"))

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(kinds) and state in ("start", "u"):
            options.append((0, "", ()))
        to = {"start": "a", "first": "a", "u": "a", "a": "u"}[state]
        role = {"a": "assistant"}.get(state, "user")

        def then(cost, letter, made, *where):
            rest = best(*where)
            if rest:
                options.append((cost + rest[0], letter + rest[1], made + rest[2]))

        if inserted < 2:
            then(5, "I", ((role, ""),), i, to, inserted + 1)
        if i < len(kinds):
            then(2, "D", (), i + 1, state, 0)
            if kinds[i] is not None:
                if kinds[i] == role[0]:
                    then(extra[i], "K", (turns[i],), i + 1, to, 0)
                else:
                    then(1 + extra[i], "R", ((role, turns[i][1]),), i + 1, to, 0)
                if state == "start" and kinds[i] == "s":
                    then(extra[i], "K", (turns[i],), i + 1, "first", 0)
        return min(options, key=lambda o: o[:2]) if options else None

    cost, audit, made = best(0, "start", 0)
    return (faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            digest("\n".join(f"{r}:{t}" for r, t in made)))


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", "s2", "User"]
TEXTS = ["Hi.", "What? ", "cut off", " ", "", "Yes!\n", "a.", "b.", "c.", "d.", "e.", "f", "g"]


def test_repair_tables_and_folds_agree():
    for n in range(0, 6):
        for kinds in product("sua-", repeat=n):
            extra = [5 * (zlib.crc32(f"{k}{kinds}".encode()) % 4 == 0) for k in range(n)]
            assert repair.tabled("".join(kinds), extra) == repair.folded("".join(kinds), extra)
    r = random.Random(3)
    for n in (12, 30, 60):
        for _ in range(12):
            kinds, extra = "".join(r.choices("sua-", k=n)), r.choices([0, 0, 5], k=n)
            assert repair.tabled(kinds, extra) == repair.folded(kinds, extra)


def test_repair_bands_lose_nothing():
    r = random.Random(4)
    for _ in range(200):
        n, m = r.randint(0, 8), r.choice([0, 2, 3, 4, 5, 6, 7])
        kinds, extra, wanted = "".join(r.choices("sua-", k=n)), r.choices([0, 5], k=n), repair.target(m)
        whole = repair.aligned(kinds, extra, wanted, 500)
        if whole is None:
            assert wanted[:1] == "s" and "s" not in kinds
            continue
        assert repair.aligned(kinds, extra, wanted, whole[0]) == whole
        assert repair.aligned(kinds, extra, wanted, whole[0] - 1) is None


@pytest.mark.parametrize("longest", [256, 3])
def test_repair_against_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(repair, "LONGEST", longest)
    r = random.Random(2)
    rows = [(c, t, r.choice(ROLES), r.choice(TEXTS)) for c in range(150) for t in sorted(r.choices([None, *range(9)], k=r.randint(1, 9)),
                                                                                         key=lambda t: -1 if t is None else t)]
    rows += [(None, None, None, None), (None, 0, "user", None), (None, None, "user", "x"), (900, None, None, "Null role."),
             (901, 5, "user", "x " * 60_000 + "."), (901, 6, "assistant", "y" * 100_000)]
    rows += [(902, t % 4, "user", f"copy {t % 3}.") for t in range(120)]
    turns = spark.createDataFrame([(*row, 1, "x") for row in rows], "conv_id long, turn long, role string, text string, times int, cost string")
    out = repair.repair(repair.damaged(turns.repartition(6)), copies="copies")
    said = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    got = {row["conv_id"]: tuple(row)[1:] for row in out.withColumn("repaired", F.sha2(F.array_join(said, "\n"), 256)).collect()}
    want = {}
    by_id = defaultdict(list)
    for c, t, role, text in rows:
        by_id[c]
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault <= 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        by_id[c] += [(t, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for c, own in by_id.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        known = {t for t, _, _ in own if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        want[c] = (gaps, *brute_repair([x[1:] for x in own]))
    assert got == want


def test_repair_query_returns_every_conversation(spark, folder):
    rows = catalog.op12_repair(spark, folder)
    turns = table(spark, folder, "conversations")
    assert rows.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows.count() == turns.select("conv_id").distinct().count()
    none = turns.filter("false")
    assert repair.repair(repair.damaged(none), copies="copies").collect() == []


def test_repair_without_rows_left(spark):
    turns = spark.createDataFrame([(1, 1, "user", "Hi.", 0)], "conv_id int, turn int, role string, text string, copies int")
    assert [tuple(r) for r in repair.repair(turns, copies="copies").collect()] == [(1, 0, 0, 0, 0, 0, 0, "", [])]


# phrases


def brute_phrases(rows, least, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = tuple(w for w in re.split(r"[ \t]+", piece) if w)
            n[lang] += len(words)
            f.update((lang, words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, words), a in found.items():
        if any(o[0] == lang and len(o[1]) > len(words) and 100 * b >= 80 * a
               and any(o[1][i:i + len(words)] == words for i in range(len(o[1]) - len(words) + 1)) for o, b in found.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rest in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rest)[:top]))


@pytest.fixture(scope="module")
def phrase_rows():
    r = np.random.default_rng(5)
    words = ["New", "york", "the", "of", "city", "\x01odd", "é", "Á", "word-x", "city\x02"]
    rows = []
    for k in range(300):
        text = " ".join(r.choice(words, r.integers(1, 30), p=[.2, .2, .15, .15, .1, .04, .04, .04, .04, .04]))
        text = text.replace("the of", "the, of").replace("é é", "é\té").replace("odd the", "odd\nthe")
        rows.append((["en", "de", None][k % 3], text))
    return rows + [("en", None), ("en", ""), ("fr", " \t ... "), ("de", "New york city " * 3000), *[rows[0]] * 20]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_against_brute_force(spark, phrase_rows, monkeypatch, small):
    if small:  # many shards, flushes and parts, and phrases of more than 64 bits
        for name, value in (("SHARD_BYTES", 500), ("FLUSH_WORDS", 300), ("PART_WORDS", 400), ("SPLIT_WORDS", 2000)):
            monkeypatch.setattr(phrases, name, value)
    docs = spark.createDataFrame([(k, lang, text, 1, "x") for k, (lang, text) in enumerate(phrase_rows)],
                                 "doc_id long, lang string, text string, shard int, words string").repartition(4)
    out = phrases.collocations(docs, least=4, top=40, id_bits=20 if small else None)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_phrases(phrase_rows, 4, 40)
    assert len(want) > 60
    assert sorted(tuple(r) for r in out.collect()) == want
    assert phrases.collocations(docs.filter("false")).collect() == []


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 32), (3, 7), (3, 20), (4, 16), (4, 32)])
def test_filters_lose_nothing(n, bits):
    r = np.random.default_rng(n * bits)
    words = [r.integers(1, 1 << bits, 5000).astype(np.int64) for _ in range(n)]
    packing = phrases.Packing(n, bits)
    high, low = packing.permuted(words)
    assert all((a == b.astype(np.int64)).all() for a, b in zip(words, packing.words(high, low)))
    ids = np.concatenate([np.stack(words, 1), np.zeros((5000, 1), np.int64)], 1).ravel()
    ids = np.concatenate([ids, np.tile(ids[:n + 1], 400)])
    want = Counter(zip(*(w.tolist() for w in words)))
    want[tuple(ids[:n].tolist())] += 400
    for part_bits in (0, 3):
        found = {}
        for f in phrases.phrase_filters(ids, n, bits, part_bits):
            again = phrases.QuotientFilter.read(f.packed(), packing.half, f.part)
            both = phrases.QuotientFilter.merged([again, f])
            assert (both.counts == 2 * f.counts).all()
            back = np.stack(packing.words(again.high, again.low), 1).tolist()
            found |= dict(zip(map(tuple, back), again.counts.tolist()))
        assert found == want
