"""Relevance of links and priority of URLs, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.terms import ANCHOR_TOKENS, ANCHOR_WORD, DOCUMENT_TERMS, PATH_TERMS, TOPICAL_TERMS
from linkloom.functions.text import occurrences
from linkloom.functions.urls import url_path


def term_total(text: Column, terms: Sequence[str]) -> Column:
    """Summed occurrences of the terms; a term listed twice counts twice."""
    return reduce(add, [occurrences(text, t) for t in terms], F.lit(0))


def link_relevant(url: Column, anchor: Column, terms: Sequence[str] = DOCUMENT_TERMS,
                  anchor_word: str = ANCHOR_WORD, anchor_tokens: Sequence[str] = ANCHOR_TOKENS) -> Column:
    """Whether a link is worth following, from the terms in its path and its anchor text.

    The hits in both add up in list order. A link counts as soon as the sum is at least 2 at a term
    the text lacks, or at least 5 at any term, or when anchor word and one anchor token occur.
    """
    path, text = F.lower(url_path(url)), F.lower(F.coalesce(anchor, F.lit("")))
    found = F.struct(path.alias("path"), text.alias("text"))

    def step(place: Column):
        def after(state: Column, term: Column) -> Column:
            in_text = occurrences(place.text, term)
            total = state.total + in_text + occurrences(place.path, term)
            hit = state.hit | ((in_text == 0) & (total >= 2)) | (total >= 5)
            return F.struct(total.alias("total"), hit.alias("hit"))

        return after

    def judge(place: Column) -> Column:
        counted = F.aggregate(F.array(*map(F.lit, terms)), F.struct(F.lit(0).alias("total"), F.lit(False).alias("hit")),
                              step(place)) if terms else F.struct(F.lit(False).alias("hit"))

        def named(word: str) -> Column:
            return F.contains(place.text, F.lit(word)) | F.contains(place.path, F.lit(word))

        return counted.hit | (named(anchor_word) & reduce(or_, map(named, anchor_tokens), F.lit(False)))

    return F.element_at(F.transform(F.array(found), judge), 1)


def inlink_score(n_inlinks: Column) -> Column:
    return F.coalesce(n_inlinks, F.lit(0)) / F.lit(1000.0)


def frontier_score(url: Column, wave: Column, n_inlinks: Column, topical_terms: Sequence[str] = TOPICAL_TERMS,
                   path_terms: Sequence[str] = PATH_TERMS) -> Column:
    """Priority of a waiting URL: early wave, many inlinks, topical terms in URL and path."""
    return (F.lit(3.0) / wave + inlink_score(n_inlinks) + term_total(F.lower(url), topical_terms)
            + term_total(F.lower(url_path(url)), path_terms))


def truncate(value: Column, precision: float = 1e-6) -> Column:
    """A non-negative value cut to whole multiples of ``precision``."""
    units = F.lit(float(round(1 / precision)))
    return F.floor(value * units) / units
