import pytest
from pyspark.sql import functions as F

from linkloom.functions import text
from linkloom.functions.porter import stem_word
from linkloom.operators import index, search

# published word pairs of the algorithm's description
PAIRS = """caresses caress ponies poni ties ti cats cat feed feed agreed agre plastered plaster bled bled motoring motor
sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz
failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc
hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow
inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement
replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll""".split()


@pytest.mark.parametrize("word, stem", list(zip(PAIRS[::2], PAIRS[1::2])))
def test_stem(word, stem):
    assert stem_word(word) == stem


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_strip_all_white_space(spark):
    assert one(spark, text.strip(F.lit(" \t\r\n a b \n"))) == "a b"


@pytest.mark.parametrize("where, what, n", [("aaaa", "aa", 2), ("core power core", "core", 2), ("", "x", 0), ("a.b.", ".", 2)])
def test_occurrences(spark, where, what, n):
    assert one(spark, text.occurrences(F.lit(where), what)) == n == where.count(what)


def test_chain_order(spark):
    terms = one(spark, text.analyze(F.lit("The plant's Ærøskøbing Straße was l’eau's niño, U.S.A 3.14"), ["was"]))
    assert terms == ["the", "plant", "aeroskobing", "strasse", "l", "nino", "u.s.a", "3.14"]
    plain = one(spark, text.analyze(F.lit("The plant's Ærøskøbing Straße l’eau's niño, U.S.A 3.14")))
    assert plain == terms


def test_stop_before_lower(spark):
    docs = spark.createDataFrame([(1, "The core of the plant")], "doc_id int, text string")
    rows = index.positioned_terms(docs, stop_words=["the", "of"]).orderBy("pos").collect()
    assert [(r.pos, r.token, r.term) for r in rows] == [(0, "The", "the"), (1, "core", "core"), (4, "plant", "plant")]
    later = index.positioned_terms(docs, stop_words=["the", "of"], stop_after_lower=True)
    assert sorted(r.pos for r in later.collect()) == [1, 4]


def test_postings_hold_every_kept_token(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = index.positioned_terms(docs, stop_words=["the"]).count()
    total = index.postings(docs, stop_words=["the"]).agg(F.sum("tf"), F.sum(F.size("positions"))).first()
    assert tuple(total) == (kept, kept)


def test_whole_text_and_word_by_word_analysis_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "İstanbul ǅ ŒUVRE naïve's ẞ ﬁn K Ⅷ x\u0301y don't.stop")], "doc_id long, text string")
    docs = docs.unionByName(extra)
    whole = docs.select("doc_id", F.explode(text.analyze(F.col("text"))).alias("term"))
    words = index.positioned_terms(docs).select("doc_id", "term")
    assert whole.exceptAll(words).collect() == [] and words.exceptAll(whole).collect() == []


def test_stemmed_index_joins_word_forms(spark):
    docs = spark.createDataFrame([(1, "reactors reaction"), (2, "reactor Reactor"), (3, None)], "doc_id int, text string")
    rows = {(r.term, r.doc_id): r.tf for r in index.postings(docs, stem=True).collect()}
    assert rows == {("reactor", 1): 1, ("reaction", 1): 1, ("reactor", 2): 2}


def test_stored_index_gives_the_same_scores(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    path = str(tmp_path / "index")
    index.write_index(docs, path, buckets=8)
    index.write_index(docs.limit(1), path, buckets=8)  # an existing index is left alone
    stored = index.StoredIndex(spark, path)
    direct = {r.doc_id: round(r.score, 9) for r in search.bm25_documents(docs, "thing thble thing").collect()}
    assert direct
    assert {r.doc_id: round(r.score, 9) for r in search.bm25_index(stored, "thing thble thing").collect()} == direct
    assert search.bm25_index(stored, "nowhere").count() == 0
    assert search.bm25_documents(docs, "...").count() == 0


def test_pages_do_not_overlap_but_legacy_pages_do(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", "text", F.lit("").alias("title"), F.col("source").alias("author"))
    ids = lambda **kw: [r.doc_id for r in search.search_page(docs, "thing thble", size=3, **kw).orderBy("rank").collect()]
    first, second, legacy = ids(), ids(page=2), ids(page=2, legacy_offset=True)
    assert len(set(first + second)) == 6
    assert legacy == first[1:] + second[:1]


def test_a_page_is_the_head_of_a_larger_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", "text", F.lit("T").alias("title"), F.col("source").alias("author"))
    small, large = (search.search_page(docs, "thing thble", size=n).orderBy("rank").collect() for n in (5, 2000))
    assert small == large[:5]


def test_stops_inside_words_end_no_sentence(spark):
    shown = one(spark, search.highlight(F.lit("The u.s. one. See 3.5 and u.s here. None."), ["u.s", "3.5"], fragments=None))
    assert shown == "The <em>u.s</em>. … See <em>3.5</em> and <em>u.s</em> here."


def test_combining_marks_belong_to_their_word(spark):
    from linkloom.functions import text

    assert one(spark, text.analyze(F.lit("re\u0301sume\u0301 x"))) == ["resume", "x"]


def test_a_new_index_version_takes_the_place_of_the_old(spark, tmp_path):
    from linkloom.operators import index

    path = str(tmp_path / "index")
    first = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    second = spark.createDataFrame([(2, "b c c")], "doc_id long, text string")
    index.write_index(first, path, buckets=4)
    index.write_index(second, path, buckets=4)
    assert [r.doc_id for r in index.StoredIndex(spark, path).postings(["b"]).collect()] == [1]
    index.write_index(second, path, buckets=2, replace=True)
    stored = index.StoredIndex(spark, path)
    assert [(r.df, r.cf) for r in stored.term_stats(["c"]).collect()] == [(1, 2)]
    assert [r.doc_id for r in stored.postings(["b"]).collect()] == [2]


def test_highlight_follows_the_analyzer(spark):
    shown = one(spark, search.highlight(F.lit("Le café. No coffee! A <b>CAFE</b> & cafés"), ["cafe"]))
    assert shown == "Le <em>café</em>. … A &lt;b&gt;<em>CAFE</em>&lt;/b&gt; &amp; cafés"
    assert one(spark, search.highlight(F.lit("nothing here"), ["cafe"])) == ""


def test_combined_scores_are_scaled_by_their_largest(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "doc_id int")
    a = spark.createDataFrame([(1, 4.0), (2, 2.0)], "doc_id int, score double")
    b = spark.createDataFrame([(2, 10.0)], "doc_id int, score double")
    out = search.combine_scores(ids, [(a, 0.5), (b, 0.5)]).collect()
    assert {r.doc_id: r.score for r in out} == {1: 0.5, 2: 0.75, 3: 0.0}
