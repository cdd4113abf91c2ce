"""From captured pages to titles, text blocks, clean text and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.markup import BOILERPLATE, decoded, read_markup
from linkloom.functions.scores import link_relevant
from linkloom.functions.urls import canonicalize
from linkloom.session import ship_package


def page_title(html: Column) -> Column:
    """The title, or ``""``."""
    return decoded(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def full_text(html: Column) -> Column:
    """All text of a page: scripts, styles, comments and tags taken out."""
    return decoded(F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1>|<!--.*?-->|<[^>]*>", ""))


def is_valid_response(status: Column, headers: Column) -> Column:
    """A page came, and it is HTML; a response without a content type is not."""
    kind = F.coalesce(F.try_element_at(headers, F.lit("content-type")), F.lit(""))
    return F.coalesce(status < 400, F.lit(False)) & F.contains(kind, F.lit("text/html"))


def parse_pages(pages: DataFrame, rules: Sequence[str] = BOILERPLATE, nested: str = "once") -> DataFrame:
    """The pages with the column ``markup``; every HTML text is parsed once, in its own task."""
    ship_package(pages.sparkSession)
    return pages.withColumn("markup", read_markup(F.col("html"), list(rules), nested))


def page_blocks(parsed: DataFrame) -> DataFrame:
    """``page_id, block_no, block``."""
    return parsed.select("page_id", F.posexplode("markup.blocks").alias("block_no", "block"))


def clean_text(parsed: DataFrame) -> DataFrame:
    """``page_id, text``: blocks one per line."""
    return parsed.select("page_id", F.array_join("markup.blocks", "\n").alias("text"))


def page_anchors(parsed: DataFrame, scope: str = "content") -> DataFrame:
    """``page_id, url, href, anchor, link`` of the links in blocks and reference lists, or of all (``scope='all'``).

    ``link`` is the canonical form. It is made before the lists are exploded, where a filter on it
    cannot be moved below and have it made again.
    """
    found = F.col("markup.all_links") if scope == "all" else F.concat("markup.links", F.filter(
        "markup.references", lambda r: r.href != ""))
    known = F.transform(found, lambda a: F.struct(
        a.href.alias("href"), a.anchor.alias("anchor"), canonicalize(a.href, F.col("url")).alias("link")))
    return parsed.select("page_id", "url", F.inline(known))


def page_links(anchors: DataFrame, ignore: Sequence[str] = (), relevance: dict | None = None) -> DataFrame:
    """``page_id, url, link``: links of a page, each once, without empty ones.

    ``relevance`` holds the arguments of the relevance rule; without it every link is kept. The
    cheap tests come before it.
    """
    links = anchors.filter("link != ''")
    if ignore:
        links = links.filter(~F.col("link").isin(list(ignore)))
    if relevance is not None:
        links = links.filter(link_relevant(F.col("link"), F.col("anchor"), **relevance))
    return links.select("page_id", "url", "link").dropDuplicates(["page_id", "link"])


def drop_ignored(links: DataFrame, ignore: DataFrame) -> DataFrame:
    """Links whose URL is not in the table ``ignore(url)``."""
    return links.join(ignore.select(F.col("url").alias("link")).distinct(), "link", "left_anti")
