"""Queries over captured pages, URLs and the crawl frontier."""

from pyspark.sql import functions as F

from catalog import sqlparts as q
from linkloom.functions import scores, urls
from linkloom.operators import frontier, linkgraph, pages
from linkloom.plans import crawl as crawling
from linkloom.session import checkpoint, shared_path
from linkloom.sources.pagestore import PageStore
from linkloom.sources.tables import part_graph, read_table, scan_pages as read_pages

PLACES = 9
# these occur in the test pages, unlike the default topic
RELEVANT = dict(terms=["the", "ing", "er", "the", "attion", "ion"], anchor_word="th", anchor_tokens=["st", "nd"])
TOPICAL = ["thing", "ing", "the", "the", "example"]
IN_PATH = ["th", "er", "ing"]


def scan_pages(spark, folder):
    return read_pages(spark, folder).select("page_id", "url", F.length("html").alias("n_chars"))


def page_title(spark, folder):
    return read_pages(spark, folder).select("page_id", pages.page_title(F.col("html")).alias("title"))


def page_blocks(spark, folder):
    return pages.page_blocks(pages.parse_pages(read_pages(spark, folder)))


def page_clean_text(spark, folder):
    return pages.clean_text(pages.parse_pages(read_pages(spark, folder)))


def page_full_text(spark, folder):
    return read_pages(spark, folder).select("page_id", pages.full_text(F.col("html")).alias("text"))


def _anchors(spark, folder):
    return pages.page_anchors(pages.parse_pages(read_pages(spark, folder), rules=[]), scope="all")


def page_links(spark, folder):
    return pages.page_links(_anchors(spark, folder)).select("page_id", "link")


def link_relevance(spark, folder):
    return _anchors(spark, folder).select(
        "page_id", "href", "anchor", scores.link_relevant(F.col("href"), F.col("anchor"), **RELEVANT).alias("relevant"))


def canonical_urls(spark, folder):
    base = F.col("url")
    forms = [base, F.upper(urls.url_scheme(base)), F.lit("/The#x"), F.lit("a/b.html"),
             F.concat(F.lit("../"), F.col("page_id"), F.lit("/./a.html")), F.lit("?q=%c3%a9"), F.lit("#top"),
             F.lit("//Other.Example.org:80/x"), F.lit("/für/é"), F.lit("")]
    forms[1] = F.concat(F.upper(urls.url_scheme(base)), F.lit("://"), F.upper(urls.url_host(base)), F.lit(":443"),
                        urls.url_path(base))
    table = read_table(spark, folder, "pages").select("page_id", "url", F.posexplode(F.array(*forms)).alias("form", "href"))
    return table.select("page_id", "form", "href", urls.canonicalize(F.col("href"), base).alias("canonical"))


def url_parts(spark, folder):
    url = F.col("url")
    return read_table(spark, folder, "pages").select(
        "page_id", urls.url_scheme(url).alias("scheme"), urls.url_host(url).alias("host"),
        urls.url_path(url).alias("path"), urls.url_query(url).alias("query"), urls.cut_fragment(url).alias("bare"))


def term_hits(spark, folder):
    table = read_table(spark, folder, "pages").select("page_id", F.lower("url").alias("url"), F.explode(F.array(*map(F.lit, IN_PATH))).alias("term"))
    return table.select("page_id", "term", scores.occurrences(F.col("url"), F.col("term")).alias("n"))


def _links(spark, folder):
    return checkpoint(pages.page_links(_anchors(spark, folder)))


def _secure(links):
    """Links of the pages served over https stand for those already handled."""
    return links.filter(F.startswith("url", F.lit("https:"))).select(F.col("link").alias("url"))


def frontier_unvisited(spark, folder):
    links = _links(spark, folder)
    queue = links.select(F.length("link").alias("level"), F.col("link").alias("url"))
    return frontier.unvisited(queue, _secure(links))


def ignore_filter(spark, folder):
    links = _links(spark, folder)
    return pages.drop_ignored(links.select("page_id", "link"), _secure(links))


def frontier_score(spark, folder):
    links = _links(spark, folder)
    queue = links.groupBy(F.col("link").alias("url")).agg(F.min("page_id").alias("level")).withColumn("level", F.col("level") + 1)
    counts = linkgraph.inlink_count(links.select(F.col("url").alias("src"), F.col("link").alias("dst")))
    scored = frontier.score_frontier(queue, counts, topical_terms=TOPICAL, path_terms=IN_PATH)
    return scored.withColumns({c: F.round(c, PLACES) for c in ("score", "inlink_score")})


def politeness_audit(spark, folder):
    log = read_table(spark, folder, "events").select(
        F.col("event_id").alias("access_id"), F.col("user_id").alias("host"), "ts")
    audit = frontier.politeness_audit(log, delay=3600.0)
    return audit.withColumns({c: F.round(c, 6) for c in ("gap", "to_sleep")})


def crawl_wave(spark, folder):
    table = read_pages(spark, folder)
    rules = crawling.CrawlRules(boilerplate=[], scope="all", relevance=None, batch_step=None,
                                score_terms=dict(topical_terms=TOPICAL, path_terms=IN_PATH))
    state = crawling.crawl_wave(crawling.start(table.select("url"), rules), crawling.captured(table), rules)
    counts = state.edges.groupBy(F.col("src").alias("url")).agg(F.count("*").alias("n_links"))
    return state.scores.join(counts, "url", "left").select(
        "url", "wave", F.round("score", PLACES).alias("score"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def crawl_two_waves(spark, folder):
    """Two waves over a page store: the captured pages, then the links they lead to, of which no page was captured."""
    table = read_pages(spark, folder)
    rules = crawling.CrawlRules(boilerplate=[], scope="all", relevance=None, batch_step=None,
                                score_terms=dict(topical_terms=TOPICAL, path_terms=IN_PATH))
    store = PageStore.write(crawling.captured(table), shared_path(spark, "pages"), buckets=8)
    state = crawling.crawl(crawling.start(table.select("url"), rules), store, rules, max_waves=2)
    counts = state.edges.groupBy(F.col("src").alias("url")).agg(F.count("*").alias("n_links"))
    read = state.scores.select("url", "wave", F.round("score", PLACES).alias("score"))
    return state.completed.join(read, "url", "left").join(counts, "url", "left").select(
        "url", "wave", "score", F.coalesce("n_links", F.lit(0)).alias("n_links"))


_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: str, n: int) -> str:
    return f"regexp_extract({url}, '{_URL}', {n})"


_SCHEME, _HOST = _part("url", 1), f"substr({_part('url', 2)}, 3)"
_ROOT = f"{_SCHEME} || ':' || {_part('url', 2)}"
_FOLDER = f"regexp_replace({_part('url', 3)}, '[^/]*$', '')"
_UP = "regexp_replace(regexp_replace({0}, '/$', ''), '[^/]*$', '')"


def _escaped(path: str) -> str:
    out = f"url_encode({path})"
    for sign in "~:/[]@!$&'()*+,;=":
        out = f"replace({out}, '%{ord(sign):02X}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return out


_BARE = "split_part(url, '#', 1)"
_FORMS = [
    ("url", _BARE),
    (f"upper({_SCHEME}) || '://' || upper({_HOST}) || ':443' || {_part('url', 3)}",
     f"{_SCHEME} || '://' || {_HOST} || case when {_SCHEME} = 'https' then '' else ':443' end || {_part('url', 3)}"),
    ("'/The#x'", f"{_ROOT} || '/The'"),
    ("'a/b.html'", f"{_ROOT} || {_FOLDER} || 'a/b.html'"),
    ("'../' || page_id || '/./a.html'", f"{_ROOT} || {_UP.format(_FOLDER)} || page_id || '/a.html'"),
    ("'?q=%c3%a9'", f"{_ROOT} || {_part('url', 3)} || '?q=%C3%A9'"),
    ("'#top'", "''"),
    ("'//Other.Example.org:80/x'", f"{_SCHEME} || '://other.example.org' || case when {_SCHEME} = 'http' then '' else ':80' end || '/x'"),
    ("'/für/é'", f"{_ROOT} || '/f%C3%BCr/%C3%A9'"),
    ("''", "''"),
]
_CANONICAL = " union all ".join(
    f"select page_id, {i} as form, {href} as href, {canonical} as canonical from pages" for i, (href, canonical) in enumerate(_FORMS))

_TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"


def _plain(expr: str) -> str:
    for name, sign in {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&middot;": "·", "&copy;": "©", "&amp;": "&"}.items():
        expr = f"replace({expr}, '{name}', '{sign}')"
    return expr


# the test pages have no tag inside a block but <b> at its start and <br> at its end
_CONTENT = r"regexp_replace(html, '(?s)<(nav|footer)>.*?</(nav|footer)>|<script>.*?</script>', '', 'g')"
_BLOCK_LIST = rf"regexp_extract_all({_CONTENT}, '<(?:p|h1)>((?:[^<]|</?b>|<br>)*)', 1)"
_BLOCKS = (f"select page_id, generate_subscripts(b, 1) - 1 as block_no, "
           f"{q.strip(_plain('''regexp_replace(unnest(b), '<[^>]*>', '', 'g')'''))} as block from (select page_id, {_BLOCK_LIST} as b from pages)")
_ANCHOR_ROWS = ("select page_id, url, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1)) as href, "
                "unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 2)) as anchor from pages")
_ANCHORS = f"select page_id, url, {_plain('href')} as href, {_plain('anchor')} as anchor from ({_ANCHOR_ROWS})"
_LINKS = f"select distinct page_id, url, {_ROOT} || {_escaped('href')} as link from ({_ANCHORS})"
_HANDLED = f"select link from ({_LINKS}) where url like 'https:%'"


def _count(text: str, term: str) -> str:
    return f"(length({text}) - length(replace({text}, {term}, ''))) // length({term})"


def _rule_sql() -> str:
    values = ", ".join(f"({i}, '{t}')" for i, t in enumerate(RELEVANT["terms"]))
    word, tokens = RELEVANT["anchor_word"], RELEVANT["anchor_tokens"]

    def named(w):
        return f"(contains(txt, '{w}') or contains(path, '{w}'))"

    anchors = f"select row_number() over () as k, page_id, href, anchor, lower({_part('href', 3)}) as path, lower(anchor) as txt from ({_ANCHORS})"
    return (
        f"with a as materialized ({anchors}), w(pos, term) as (values {values}), "
        f"s as (select a.k, {_count('txt', 'term')} as tc, sum({_count('txt', 'term')} + {_count('path', 'term')}) over (partition by a.k order by pos) as total from a cross join w), "
        "h as (select k, bool_or((tc = 0 and total >= 2) or total >= 5) as hit from s group by k) "
        f"select page_id, href, anchor, hit or ({named(word)} and ({' or '.join(map(named, tokens))})) as relevant from a join h using (k)")


def _score_sql(url: str, wave: str, n: str) -> str:
    path = f"lower({_part(url, 3)})"
    hits = " + ".join([_count(f"lower({url})", f"'{t}'") for t in TOPICAL] + [_count(path, f"'{t}'") for t in IN_PATH])
    return f"round(3.0::double / {wave} + {n} / 1000.0::double + {hits}, 9)"


_GAP = "(epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id)) / 1000000.0::double"

ENTRIES = {
    "scan_pages": (scan_pages, "select page_id, url, length(html) as n_chars from pages"),
    "page_title": (page_title, f"select page_id, {_plain(_TITLE)} as title from pages"),
    "page_blocks": (page_blocks, _BLOCKS),
    "page_clean_text": (
        page_clean_text, f"select page_id, string_agg(block, chr(10) order by block_no) as text from ({_BLOCKS}) group by page_id"),
    "page_full_text": (
        page_full_text,
        rf"select page_id, {_plain('''regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[^>]*>', '', 'g')''')} as text from pages"),
    "page_links": (page_links, f"select page_id, link from ({_LINKS})"),
    "link_relevance": (link_relevance, _rule_sql()),
    "canonical_urls": (canonical_urls, _CANONICAL),
    "url_parts": (
        url_parts,
        f"select page_id, {_SCHEME} as scheme, {_HOST} as host, {_part('url', 3)} as path, "
        f"substr({_part('url', 4)}, 2) as query, {_BARE} as bare from pages"),
    "term_hits": (
        term_hits,
        f"select page_id, term, {_count('lower(url)', 'term')} as n from pages cross join (values {', '.join(f'({chr(39)}{t}{chr(39)})' for t in IN_PATH)}) w(term)"),
    "frontier_unvisited": (
        frontier_unvisited,
        f"select distinct length(link) as level, link as url from ({_LINKS}) where link not in ({_HANDLED})"),
    "ignore_filter": (ignore_filter, f"select page_id, link from ({_LINKS}) where link not in ({_HANDLED})"),
    "frontier_score": (
        frontier_score,
        f"select link, wave, {_score_sql('link', 'wave', 'n')} as score, round(n / 1000.0::double, 9) as inlink_score from "
        f"(select link, min(page_id) + 1 as wave, count(*) as n from ({_LINKS}) group by link)"),
    "politeness_audit": (
        politeness_audit,
        f"select access_id, host, round(gap, 6) as gap, round(3600 - gap, 6) as to_sleep, "
        "case when gap is null or 3600 - gap <= 0 then 'go' when 3600 - gap > 5 then 'skip' else 'wait' end as action "
        f"from (select event_id as access_id, user_id as host, {_GAP} as gap from events)"),
    "crawl_wave": (
        crawl_wave,
        # two captures of one URL are one page, the one with the smallest id
        f"with l as (select page_id, count(*) as n from ({_LINKS}) group by page_id), "
        f"p as (select {_BARE} as url, min(page_id) as page_id from pages group by 1) "
        f"select url, 1 as wave, {_score_sql('url', '1', '0')} as score, coalesce(n, 0) as n_links from p left join l using (page_id)"),
    "crawl_two_waves": (
        crawl_two_waves,
        f"with k as materialized (select page_id, link from ({_LINKS})), "
        f"p as materialized (select {_BARE} as url, min(page_id) as page_id from pages group by 1), "
        "l as (select page_id, count(*) as n from k group by page_id) "
        f"select url, 1 as wave, {_score_sql('url', '1', '0')} as score, coalesce(n, 0) as n_links from p left join l using (page_id) "
        "union all select distinct link, null, null, 0 from k join p using (page_id) where link not in (select url from p)"),
}
