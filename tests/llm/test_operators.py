"""Each operator against a brute-force version on a small table with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from linkloom.llm import catalog, chat, extract, packing, pieces, rules, simhash, sketch, slots, suffix, toxicity
from linkloom.llm.common import table
from linkloom.llm.components import roots

WORDS = [a + b for a, b in product("bad kel mor tis nu pa".split(), "do ra lin ve s".split())]


def text_of(seed: int, n: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join(r.choice(WORDS, n)) if n else ""


@pytest.fixture(scope="module")
def rows():
    passage = text_of(99, 60)
    long = text_of(7, 30_000)
    return [
        (1, text_of(1, 200) + passage, "x"), (2, None, None), (3, "", "y"), (4, "  \n\t", "y"), (5, "Hello", "z"),
        (6, passage + text_of(2, 50), None), (7, text_of(1, 200) + passage, "copy"), (7, text_of(3, 80), "tie"),
        (8, text_of(4, 120), "row"), (8, text_of(4, 120), "row"), (9, long, "long"), (10, long[:9000], "part"),
        (None, passage, "null id"), (None, "é" * 60 + passage, "null id"), (12, "For " * 40, "junk"),
        (13, "a\nb\na\nb\na line\na line\na line\na line", "lines"), (14, text_of(1, 199) + " nus" + passage, "near")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # extra columns with names that operators use inside
    made = spark.createDataFrame([(i, t, e, 3, "h") for i, t, e in rows],
                                 "doc_id long, text string, score string, shard int, fp string")
    table(spark, "/root/testdata/sf0.001", "documents")  # ships the package
    return made.repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string, shard int, fp string")


def test_extract_decodes_and_joins(spark):
    html = ('<html><head><title>t</title><script>var a="<p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul>'
            '</nav><div class="ad">Buy   now.</div><article><h1>A &amp; B</h1><p><b>First  <i>para</i>.<br>More.<p>Second.</p>'
            '</article><div class="comments"><p>Nice one, thanks.</p></div><footer>&copy; me</footer></body></html>')
    pages = spark.createDataFrame([(1, "u", html), (2, None, None), (3, "v", ""), (1, "u", html)], "page_id long, url string, html string")
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in extract.main_text(pages).collect())
    want = "A & B\n\nFirst para. More.\n\nSecond."
    assert got == {(1, want, len(want)): 2, (2, "", 0): 1, (3, "", 0): 1}


@pytest.mark.parametrize("start", [
    "<head><title>t</title><meta charset=u><body>", "<head><title>t</title>", "<head><title>t<body>",
    "<head><title>t</title><script>var a='İ<p>';</script></head><body>",
    "<head><title>İİİ</title><style>p { }</STYLE></head><body><script>1</script>"])
def test_extract_blocks_without_head_end_and_with_growing_letters(start):
    page = extract.blocks(f"<html>{start}<div class=main><p>One İ.</p><script>x</script><p>Two.</p></div></body></html>")
    assert [text for text, *_ in page] == ["One İ.", "Two."]
    assert [[tag for tag, _ in ancestors][-2:] for _, ancestors, _ in page] == [["div", "p"]] * 2


def test_extract_text_and_inline_tags_close_head():
    for start in ("Hi ", "<b>Hi</b> "):
        page = extract.blocks(f"<html><head><link href=x><title>t</title> {start}there.<p>Two.</p>")
        assert [text for text, *_ in page] == ["Hi there.", "Two."]


@pytest.mark.parametrize("html, texts", [
    ("<p class=it's>Hello there</p><p>The world's end</p><p>Third", ["Hello there", "The world's end", "Third"]),
    ("<b title=don't>bold</b> text", ["bold text"]), ("<p>a<!-->b</p><p>c<!--->d</p>", ["ab", "cd"]),
    ("x <!-- a > b --> y", ["x y"]), ("x <!-- not closed > y", ["x"]), ("x <!-- not closed", ["x"]),
    ('<p title="a>b">q</p><p title = \'>\'>r</p>', ["q", "r"]), ("a < b and <c d", ["a < b and <c d"]),
    ('<div class="menu><p>lost</p>', ["lost"])])
def test_extract_tags_and_comments_as_they_come(html, texts):
    assert [text for text, *_ in extract.blocks(html)] == texts


def test_extract_deep_nesting_is_linear():
    page = extract.blocks("<b>" * 20_000 + "<p class=x>one <a href=y>two</a></p>" * 20_000)
    assert len(page) == 20_000 and page[-1] == ("one two", [("p", ())], 3)
    assert len(extract.blocks("<a href " * 50_000)) == 1


def test_extract_field_learns_held_out_layouts():
    field, wrong, total = extract.trained(), 0, 0
    for page, labels in extract.labelled_pages(60, seed=5):
        found = field.viterbi(page)
        wrong += sum(a != b for a, b in zip(found, labels))
        total += len(labels)
    assert wrong < 0.02 * total


def test_viterbi_is_the_best_labelling():
    field = extract.trained(40)
    for page, _ in extract.labelled_pages(12, seed=8):
        page = page[:8]
        emit = field.emissions(field.rows(page))

        def total(labels):
            steps = field.steps[extract.LABELS][labels[0]] + sum(field.steps[a, b] for a, b in zip(labels, labels[1:]))
            return steps + sum(emit[t, y] for t, y in enumerate(labels))

        best = max(product((0, 1), repeat=len(page)), key=total)
        assert total(field.viterbi(page)) == pytest.approx(total(best))


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The given vocabulary as a unigram model, whose segmentation the library can check."""
    sp = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(catalog.vocabulary("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        if piece.type == 1 and piece.score < -1e6:
            piece.score = -50000
    path = str(tmp_path_factory.mktemp("pieces") / "unigram.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    return path, sp.SentencePieceProcessor(model_file=path)


def test_pieces_match_the_library_and_stream(unigram, rows):
    path, library = unigram
    model = pieces.Pieces(path)
    for text in [t for _, t, _ in rows if t] + ["日本語 é\x00 x", "a" * 3000, "two  blanks   here "]:
        ids = np.frombuffer(model.encode(text), "<u4").tolist()
        assert ids == library.encode(text)
        assert model.decode(model.encode(text)) == text
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        for size in (1, 7):
            chunks = [marked[i:i + size] for i in range(0, min(len(marked), 900), size)]
            assert [i for part in model.stream(chunks) for i in part] == [
                i for part in model.stream(["".join(chunks)]) for i in part]


def test_pieces_hold_a_window_of_a_long_run(monkeypatch):
    model = pieces.Pieces(catalog.vocabulary("piece_bpe_32k.model"))
    run = "".join(WORDS[k % 7] + str(k % 11) for k in range(6000))
    want = [i for part in model.stream((pieces.MARK + run[:900],)) for i in part]
    collect, held = model.collect, []
    monkeypatch.setattr(model, "collect", lambda text, *rest: held.append(len(text)) or collect(text, *rest))
    assert model.decode(model.encode(run)) == run
    assert max(held) <= 4 * pieces.CHUNK < len(run)
    assert np.frombuffer(model.encode(run[:900]), "<u4").tolist() == want


def test_pieces_round_trip(docs, none):
    path = catalog.vocabulary("piece_bpe_32k.model")
    assert all(r["round_trip"] for r in pieces.summary(docs, path).collect())
    back = pieces.decoded(pieces.encoded(docs, path), path)
    assert Counter((r[0], r[1]) for r in back.collect()) == Counter((r[0], r[1] or "") for r in docs.collect())
    assert pieces.summary(none, path).collect() == []


def test_sketch_edits_against_brute_force(docs, rows, none):
    order = sorted(((i if i is not None else sketch.MIN_ID, i, t or "") for i, t, _ in rows), key=lambda x: -x[0])
    got = sketch.edited(docs).collect()
    assert len(got) == len(rows)
    texts = defaultdict(set)
    for key, _, text in order:
        texts[key].add(text)
    keys = sorted(texts, reverse=True)
    for row in got:
        key = row["doc_id"] if row["doc_id"] is not None else sketch.MIN_ID
        after = texts[keys[(keys.index(key) + 1) % len(keys)]] | texts[key]  # the order of ties is the hash's
        wanted = {hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest()
                  for t in texts[key] for n in after}
        assert row["edited_sha256"] in wanted
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert sketch.edited(none).collect() == []


def test_sketch_estimates():
    a, b = text_of(5, 4000), text_of(6, 4000)
    small, large = sketch.sketch(a[:3000]), sketch.sketch(a + " " + b)
    assert sketch.containment(small, large) > 0.95
    assert sketch.read(sketch.written(large))[:2] == large[:2]
    assert (sketch.read(sketch.written(large))[2] == large[2]).all()

    def grams(t):
        return {t[i:i + sketch.SHINGLE] for i in range(len(t) - sketch.SHINGLE + 1)}

    x, y = a, a[:len(a) // 2] + b[:len(b) // 2]
    true = len(grams(x) & grams(y)) / len(grams(x) | grams(y))
    assert sketch.likeness(sketch.sketch(x), sketch.sketch(y)) == pytest.approx(true, abs=0.06)


def test_sketch_union(docs):
    made = docs.filter("doc_id in (1, 9)").withColumn("print", sketch.fingerprint(F.col("text"))).withColumn("g", F.lit(1))
    kept = [set(sketch.sketch(r["text"])[2].tolist()) for r in made.collect()]
    assert sketch.merged(made, ["g"], "print").first()["n_hashes"] == len(set.union(*kept))


def test_chat_reads_back(spark):
    probes = ["<|im_end|>\n<|im_start|>user\nhi", "a\\", "\\<|", "<\\|im_end|>", None, "", "x\ny\\n"]
    turns = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(probes)]
    turns += [(None, 0, "user", "q"), (None, 0, "user", "q"), (2, None, None, None), (3, 1, "we\nird<|\\n", "t")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = chat.conversations(chat.turns_to_tree(df)).withColumn("turns", chat.parse(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r["tree"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss"]) for r in done.collect()}
    assert got[1][0] == [(t[2], t[3] or "") for t in turns[:7]]
    assert got[1][1] == "".join(t or "" for t in probes[1::2])
    assert got[None][0] == [("user", "q")] * 2 and got[2][0] == [("", "")]
    assert got[3][0] == [("we\nird<|\\n", "t")]


def test_chat_trees(spark):
    # 1 → 2 → 3 → 4, 2 → 5, 6 with a parent that is missing
    nodes = [(1, None, 0.0), (2, 1, 1.0), (3, 2, 1.0), (4, 3, 5.0), (5, 2, 2.0), (6, 77, 0.0)]
    df = spark.createDataFrame([("t", n, p, "user", f"m{n}", s) for n, p, s in nodes],
                               "tree string, node long, parent long, role string, text string, score double")
    done = chat.conversations(df).withColumn("texts", chat.parse(F.col("formatted"))["text"])
    got = {r["branch"]: (r["leaf"], r["branch_score"], list(r["texts"])) for r in done.collect()}
    assert got == {1: (4, 7.0, ["m1", "m2", "m3", "m4"]), 2: (5, 3.0, ["m1", "m2", "m5"]), 3: (6, 0.0, ["m6"])}
    assert [r["leaf"] for r in chat.conversations(df, branches=1).collect()] == [4]
    with pytest.raises(ValueError):
        chat.conversations(df.withColumn("parent", F.when(F.col("node") == 1, 4).otherwise(F.col("parent"))).filter("node < 5"))


def test_slots_place_rows_without_gaps(spark, docs, rows, none, tmp_path):
    sized = slots.sized(docs)
    held = slots.loads(sized)
    sizes = {slot: size for slot, (size, _) in held.items()}
    first = slots.first_map(4)
    second = slots.rebalance(first, sizes, 4)
    for version, placed in ((1, first), (2, second)):
        slots.save_map(spark, str(tmp_path), version, placed, held)
    change = slots.moved(slots.read_map(spark, str(tmp_path), 1), slots.read_map(spark, str(tmp_path), 2))
    assert change.count() == sum(first[s] != second[s] for s in first)
    got = slots.place(sized, slots.read_map(spark, str(tmp_path), 2)).collect()
    assert Counter(r["size"] for r in got) == Counter(len((t or "").encode()) + 1 for _, t, _ in rows)
    for shard in range(4):
        own = [r["slot"] for r in got if r["shard"] == shard]
        assert sorted(own) == list(range(len(own)))
    assert slots.place(slots.sized(none), slots.read_map(spark, str(tmp_path), 2)).count() == 0


def test_slots_balance_and_grow():
    r = np.random.default_rng(1)
    sizes = {s: int(x) for s, x in enumerate(r.lognormal(7, 1.5, slots.SLOTS))}
    placed = slots.rebalance(slots.first_map(16), sizes, 16)
    total = Counter()
    for slot, shard in placed.items():
        total[shard] += sizes[slot]
    assert max(total.values()) - min(total.values()) <= 0.001 * max(total.values())
    grown = slots.rebalance(placed, sizes, 17)
    assert sum(grown[s] != placed[s] for s in placed) < 0.25 * len(placed)


def brute_suffix(rows):
    first, out = {}, Counter()
    order = sorted(rows, key=lambda x: suffix.MAX_ID if x[0] is None else x[0])
    ranks = {}
    for i, t, _ in order:
        key = suffix.MAX_ID if i is None else i
        data = (t or "").encode()
        for p in range(len(data) - 49):
            ranks[data[p:p + 50]] = min(ranks.get(data[p:p + 50], key), key)
    for i, t, _ in order:
        key, data = suffix.MAX_ID if i is None else i, (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if ranks[data[p:p + 50]] < key:
                gone[p:p + 50] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_suffix_against_brute_force(docs, rows, none, monkeypatch):
    monkeypatch.setattr(suffix, "STRINGS_PER_BATCH", 1 << 12)
    got = Counter(tuple(r) for r in suffix.removals(docs).collect())
    assert got == brute_suffix(rows)
    assert suffix.removals(none).collect() == []
    cut = suffix.deduplicated(docs)
    assert cut.columns == docs.columns
    assert Counter(r["doc_id"] for r in cut.collect()) == Counter(i for i, _, _ in rows)


def test_suffix_spans_of_repeated_rows_come_once(spark, docs):
    passage = text_of(99, 60)
    rows = [(1, passage)] + [(2, text_of(1, 40) + passage)] * 50
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [r[0] for r in suffix.with_spans(made).filter("_row.doc_id = 2").select("_spans").collect()]
    assert len(found) == 50
    for spans in found:
        pairs = list(zip(spans[::2], spans[1::2]))
        assert pairs and len(pairs) == len(set(pairs))
    assert Counter(tuple(r) for r in suffix.removals(made).collect()) == brute_suffix([(i, t, None) for i, t in rows])


def test_suffix_equal_fingerprints_of_different_strings(rows, monkeypatch):
    """With a fingerprint of three bits everything collides, and the bytes decide."""
    real = suffix.string_prints
    texts = [(i, (t or "").encode()[:1500]) for i, t, _ in rows if i is not None]
    ids = np.array([i for i, _ in texts])
    outcomes = []
    for bits in (64, 3):
        monkeypatch.setattr(suffix, "string_prints", lambda data, b=bits: real(data) >> np.uint64(64 - b))
        box = suffix.Outbox(np.zeros(1 << suffix.ORDER_BITS, np.uint8), 1)
        box.add(ids, np.arange(len(ids)), [t for _, t in texts])
        sent, local = box.flush()
        found = suffix.scan_shard([p for _, p in sent])
        spans = defaultdict(list)
        for part in (local, found):
            for h, s in zip(part["text_hash"].tolist(), part["spans"].to_pylist()):
                spans[h] += s
        outcomes.append({h: suffix.merged(np.array(s).reshape(-1, 2)).tolist() for h, s in spans.items()})
    assert outcomes[0] == outcomes[1]


def test_suffix_levels_grow_geometrically():
    family = suffix.Family(np.zeros(0, np.uint8))
    for k in range(20):
        keys = np.arange(k * 100, k * 100 + 100, dtype=np.uint64)
        family.insert(keys, keys.astype(np.uint32), keys.astype(np.int32))
    sizes = [len(level[0]) for level in family.levels]
    assert sum(sizes) == 2000 and len(sizes) <= 5
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


def brute_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            best = min(fits, key=lambda b: b[0])
        else:
            best = [capacity, []]
            bins.append(best)
        best[0] -= n
        best[1].append(n)
    return Counter(tuple(b[1]) for b in bins)


def test_packing_plan_is_best_fit_decreasing():
    r = np.random.default_rng(2)
    for capacity in (10, 33, 64):
        lengths = r.integers(1, capacity + 1, 400).tolist()
        bins = defaultdict(list)
        order = sorted(lengths, reverse=True)
        runs = packing.plan(Counter(lengths), capacity)
        for k, (first, each, sequence, offset, length) in enumerate(runs):
            last = runs[k + 1][0] if k + 1 < len(runs) else len(order)
            for i in range(first, last):
                bins[sequence + (i - first) // each].append((offset + (i - first) % each * length, order[i]))
        got = []
        for own in bins.values():
            own.sort()
            assert [o for o, _ in own] == np.r_[0, np.cumsum([n for _, n in own])[:-1]].tolist()
            got.append(tuple(n for _, n in own))
        # bins with equal room may swap contents, what they hold in all may not
        assert Counter(map(sum, got)) == Counter(map(sum, brute_best_fit(lengths, capacity).elements()))


def test_packing_ids_and_places(docs, rows, none):
    from tokenizers import Tokenizer

    path = catalog.vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = ["Don't STOP, a<|endoftext|>b  É́ \t x\x1cy ΣΑΣ İ 12.5", "…"]
    codec = packing.codec(path)
    for text, ids in zip(odd, codec.ids(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    want = Counter()
    for i, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at:at + 2048]
            want[i, at // 2048, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = packing.pack(docs, path).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert sum(n for _, n in own) <= 2048
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[0][0] == 0
    assert sum(len(r["ids"]) for r in packing.sequences(docs, path).collect()) == sum(r["length"] for r in got)
    assert packing.pack(none, path).collect() == []


def test_rules_against_brute_force(docs, rows, none):
    got = Counter(tuple(r) for r in rules.ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    want = Counter()
    for i, t, _ in rows:
        t = t or ""
        words = t.encode().split()
        words = [w.decode() for w in words]
        seen = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        covered = {k + j for k in range(len(words) - 4) if seen[tuple(words[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        want[i, len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
             len(covered)] += 1
    assert got == want
    assert rules.apply_policy(rules.ledger(docs)).filter("kept").count() == sum(
        r["kept"] for r in rules.apply_policy(rules.ledger(docs)).collect())
    assert rules.ledger(none).collect() == []


def test_rules_ablation(docs):
    ledger = rules.ledger(docs)
    bits = [r["failed"] for r in ledger.collect()]
    for r in rules.ablation(ledger).collect():
        bit = rules.mask((r["rule"],))
        assert r["n_fail"] == sum(bool(b & bit) for b in bits)
        assert r["n_only"] == sum(b == bit for b in bits)
        assert r["n_kept_without"] == sum(not b & ~bit for b in bits)


def brute_fingerprint(text, size=4):
    words = [w for w in (text or "").encode().lower().split()]
    grams = [b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark, docs, rows, none):
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    got = simhash.near_duplicates(docs).collect()
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {k: min((rows[i][0] for i in range(len(rows)) if label[i] == k and rows[i][0] is not None), default=None)
             for k in set(label)}
    want = Counter((rows[i][0], prints[i], least[label[i]]) for i in range(len(rows)))
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_agrees_with_spark_hash(spark):
    row = spark.sql("select xxhash64('ab cd ef gh') as h").first()
    assert int.from_bytes(simhash.fingerprint(b"AB cd ef  gh"), "big") == row["h"] % (1 << 64)


@pytest.mark.parametrize("limit", [1 << 22, 1 << 12])
def test_simhash_links_all_within_the_radius(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "VALUES_PER_GROUP", limit)
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = set()
    for b in base.tolist():
        for _ in range(25):
            flips = r.choice(64, r.integers(0, 6), replace=False)
            fps.add(b ^ sum(1 << int(f) for f in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = {x["node"]: x["root"] for x in roots(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))).collect()}
    parent = {s: s for s in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in zip(fps, signed):
        for b, y in zip(fps, signed):
            if (a ^ b).bit_count() <= 4:
                parent[max(find(x), find(y))] = min(find(x), find(y))
    assert {s: found.get(s, s) for s in signed} == {s: find(s) for s in signed}


def test_toxicity_gradients():
    net = toxicity.Network.fresh(["mor", "tis"])
    words = ["mor", "tis", "unseen", "x"]
    x, made = net.inputs(words)
    index = np.array([[0, 2], [1, 3], [3, -1]])
    labels = np.array([1.0, 0.0], np.float32)
    g, d_gates = net.gradients(net.gates(x), index, labels)
    net.backward_inputs(x, made, d_gates, g)

    def loss():
        logit = net.run(net.gates(net.inputs(words)[0]), index).astype(np.float64)
        p = toxicity.sigmoid(logit)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, value in net.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), value.shape)
        old, step = value[at].copy(), np.float32(1e-2)
        value[at] = old + step
        up = loss()
        value[at] = old - step
        down = loss()
        value[at] = old
        assert (up - down) / (2 * float(step)) == pytest.approx(float(g[name][at]), rel=0.05, abs=2e-5), name


def test_toxicity_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 80, 81, 1000):
        starts = list(toxicity.window_starts(n))
        covered = {k for s in starts for k in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n))


def test_toxicity_scores_by_held_out_labels(spark, docs, none):
    r = np.random.default_rng(4)
    bad = ["vilefoo", "grimbar"]
    labelled = []
    for k in range(260):
        words = list(r.choice(WORDS, int(r.integers(5, 150))))
        if k % 3 == 0:
            for w in bad:
                words.insert(int(r.integers(0, len(words))), w)
        labelled.append((k, " ".join(words), int(k % 3 == 0)))
    df = spark.createDataFrame(labelled, "doc_id long, text string, toxic int")
    net = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    got = toxicity.scored(df, net).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [x for x in got if x["held"]]
    assert len(held) > 40 and all((x["score"] >= 0.3) == bool(x["toxic"]) for x in held)
    assert all(x["held"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in got)
    scores = [x["score"] for x in toxicity.scored(docs, net).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.scored(none, net).collect() == []
    assert toxicity.fit(none, df.filter("false")).run is not None
