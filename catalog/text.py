"""Queries over the document texts: analysis, index, search."""

from pyspark.sql import functions as F

from catalog import sqlparts as q
from linkloom.functions.porter import stem_word
from linkloom.operators import index, search
from linkloom.operators.store import IndexStore
from linkloom.plans import pagerank
from linkloom.session import shared_path
from linkloom.sources.tables import part_graph, read_table, spread

STOP = ["the", "of", "and", "to", "in", "is", "la", "de", "le", "der"]
WORDS = ["thing", "thble"]
QUERY = " ".join(WORDS)
TOPIC = {"thing": 2.0, "thble": 1.0, "thtion": 1.5}
PLACES = 9


def docs(spark, folder):
    return spread(read_table(spark, folder, "documents").select("doc_id", "text"))


def search_docs(spark, folder):
    table = spread(read_table(spark, folder, "documents").select("doc_id", "text", "source"))
    return table.select("doc_id", "text", F.lit("").alias("title"), F.col("source").alias("author"))


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, PLACES) for c in columns})


def tokens(spark, folder):
    return index.raw_tokens(docs(spark, folder)).select("doc_id", "pos", "token")


def stopped_tokens(spark, folder):
    return index.positioned_terms(docs(spark, folder), stop_words=STOP).select("doc_id", "pos", "token")


def analyzed_terms(spark, folder):
    return index.positioned_terms(docs(spark, folder), stop_words=STOP).select("doc_id", "doc_len", "pos", "term")


def stemmed_terms(spark, folder):
    return index.vocabulary_stems(docs(spark, folder))


def postings(spark, folder):
    rows = index.postings(docs(spark, folder))
    return rows.select("term", "doc_id", "tf", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


def term_stats(spark, folder):
    return index.term_stats(docs(spark, folder))


def top_terms(spark, folder):
    return search.top_terms(index.term_stats(docs(spark, folder)), 50)


def bm25_search(spark, folder):
    return rounded(search.bm25_documents(docs(spark, folder), QUERY), "score")


def hits_root_set(spark, folder):
    return search.root_set(docs(spark, folder), QUERY, 1000)


def search_page(spark, folder):
    return rounded(search.search_page(search_docs(spark, folder), QUERY, page=2, size=10), "score")


def search_highlight(spark, folder):
    table = docs(spark, folder)
    return table.select("doc_id", search.highlight(F.col("text"), WORDS, fragments=None).alias("fragments"))


def topical_score(spark, folder):
    return rounded(search.topical_score(docs(spark, folder), TOPIC), "score")


def combined_rank(spark, folder):
    texts = docs(spark, folder)
    ranks = pagerank.fixed_rounds(pagerank.lay_out(part_graph(spark, folder, suppliers=True)), 3)
    parts = [(search.bm25_documents(texts, QUERY), 0.5), (ranks.select(F.col("id").alias("doc_id"), F.col("rank").alias("score")), 0.3),
             (search.topical_score(texts, TOPIC), 0.2)]
    return rounded(search.combine_scores(read_table(spark, folder, "documents"), parts), "score")


def _store(spark, folder):
    """A stored index of the documents with the stop list and the stemmer."""
    return IndexStore(spark, shared_path(spark, "index"), stop_words=STOP, stem=True)


def index_search(spark, folder):
    store = _store(spark, folder).create(docs(spark, folder), "first")
    return rounded(store.search(QUERY, 100).rows, "score").select("rank", "doc_id", "score")


def _page_links(rows):
    """Links between documents by their ids, in a fixed order, as an index document carries them."""
    return rows.select(F.col("doc_id").alias("url"), F.lit("out").alias("direction"), F.posexplode(
        F.array(F.col("doc_id") + 1, F.col("doc_id") + 2)).alias("pos", "link"))


def index_upsert_stored(spark, folder):
    first = docs(spark, folder)
    items = read_table(spark, folder, "benchmark").select((F.col("item_id") * 50).alias("doc_id"), "text")
    more = _page_links(items).withColumn("link", F.col("link") + 1)
    store = _store(spark, folder).create(first, "first", _page_links(first))
    store = store.upsert(items, "second", more).upsert(items, "second", more).compact()
    lists = store.links().groupBy(F.col("url").alias("doc_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("pos", "link"))), lambda x: x["link"].cast("string")), " ").alias("outlinks"))
    words = store.postings().groupBy("doc_id").agg(F.sum("tf").alias("n_terms"))
    # both grow with the index, and Spark would guess their sizes from those of files
    docs_of = store.documents(F.length("text").alias("n_chars"))
    return docs_of.join(lists.hint("merge"), "doc_id", "left").join(words.hint("merge"), "doc_id", "left").select(
        "doc_id", "n_chars", "author", "outlinks", F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        F.lit(store.number).alias("version"))


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
_KEPT = f"select doc_id, pos, token from ({q.tokens()}) where token not in ({_STOP_SQL})"
_KEPT_TERMS = f"select doc_id, pos, {q.term('token')} as term from ({_KEPT})"
_STEMMED = (f"select k.doc_id, k.pos, s.stem as term from ({_KEPT_TERMS}) k join "
            f"({q.stems(f'select term, count(*) as cf from ({_KEPT_TERMS}) group by term')}) s using (term)")
_BEST = "select doc_id, score, row_number() over (order by round(score, 9) desc, doc_id) as rank from scored"
_WEIGHT = "case term when 'thing' then 2.0 when 'thble' then 1.0 else 1.5 end::double"
_TOPIC = f"select doc_id, sum({_WEIGHT}) as score from t where term in ('thing', 'thble', 'thtion') group by doc_id"

ENTRIES = {
    "tokens": (tokens, q.tokens()),
    "stopped_tokens": (stopped_tokens, _KEPT),
    "analyzed_terms": (
        analyzed_terms,
        f"select doc_id, count(*) over (partition by doc_id) as doc_len, pos, {q.term('token')} as term from ({_KEPT})"),
    "stemmed_terms": (
        stemmed_terms, q.stems(f"select term, count(*) as cf from ({q.terms()}) group by term")),
    "postings": (
        postings,
        f"select term, doc_id, count(*) as tf, string_agg(pos::varchar, ',' order by pos) as positions from ({q.terms()}) group by term, doc_id"),
    "term_stats": (
        term_stats, f"select term, count(distinct doc_id) as df, count(*) as cf from ({q.terms()}) group by term"),
    "top_terms": (
        top_terms,
        f"select term, count(distinct doc_id) as df, count(*) as cf from ({q.terms()}) group by term order by df desc, term limit 50"),
    "bm25_search": (bm25_search, f"{q.bm25(WORDS)} select doc_id, round(score, 9) as score from scored"),
    "hits_root_set": (hits_root_set, f"{q.bm25(WORDS)} select doc_id as id from ({_BEST}) where rank <= 1000"),
    "search_page": (
        search_page,
        f"{q.bm25(WORDS)} select rank, doc_id, doc_id::varchar as title, source as author, round(score, 9) as score, "
        f"(select count(*) from scored) as total, {q.highlighted('text', WORDS)} as fragments "
        f"from ({_BEST}) join documents using (doc_id) where rank between 11 and 20"),
    "index_search": (
        index_search,
        f"{q.bm25([stem_word(w) for w in WORDS], _STEMMED)} select rank::int as rank, doc_id, round(score, 9) as score from ({_BEST}) where rank <= 100"),
    "index_upsert_stored": (
        index_upsert_stored,
        f"with i as (select item_id * 50 as doc_id, text from benchmark), "
        f"tokens_of as ({q.tokens()} union all {q.tokens('(select i.* from i anti join documents using (doc_id))')}), "
        f"n as (select doc_id, count(*) as n_terms from tokens_of where token not in ({_STOP_SQL}) group by doc_id) "
        "select coalesce(o.doc_id, i.doc_id) as doc_id, length(coalesce(o.text, i.text)) as n_chars, "
        "case when o.doc_id is null then 'second' when i.doc_id is null then 'first' else 'first second' end as author, "
        "concat_ws(' ', coalesce(o.doc_id + 1, i.doc_id + 2), coalesce(o.doc_id + 2, i.doc_id + 3), "
        "case when o.doc_id is not null then i.doc_id + 3 end) as outlinks, coalesce(n.n_terms, 0) as n_terms, 3 as version "
        "from documents o full outer join i on o.doc_id = i.doc_id left join n on n.doc_id = coalesce(o.doc_id, i.doc_id)"),
    "search_highlight": (search_highlight, f"select doc_id, {q.highlighted('text', WORDS, None)} as fragments from documents"),
    "topical_score": (topical_score, f"with t as ({q.terms()}) select doc_id, round(score, 9) as score from ({_TOPIC})"),
    "combined_rank": (
        combined_rank,
        f"{q.bm25(WORDS)}, {q.rank_rounds(q.edges(True), q.vertices(True), 3)[5:]}, topic as materialized ({_TOPIC}) "
        "select d.doc_id, round(coalesce(0.5::double * b.score / (select max(score) from scored), 0) "
        "+ coalesce(0.3::double * r / (select max(r) from r3), 0) "
        "+ coalesce(0.2::double * x.score / (select max(score) from topic), 0), 9) as score from documents d "
        "left join scored b on b.doc_id = d.doc_id left join r3 on r3.id = d.doc_id left join topic x on x.doc_id = d.doc_id"),
}
