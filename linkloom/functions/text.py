"""Column functions of the text analyzer: tokens, stop filter, apostrophes, folding, lower case."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word runs joined by an inner apostrophe or full stop; an approximation of Unicode word breaks.
# A word may hold combining marks, but not begin with one.
TOKEN_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}\p{M}_]*(?:['’.][\p{L}\p{N}_][\p{L}\p{N}\p{M}_]*)*"
WORD_CHAR = r"[\p{L}\p{N}\p{M}_]"
# What follows the first apostrophe of a word, up to the word's end.
APOSTROPHE_TAIL = r"([\p{L}\p{N}\p{M}_])['’][\p{L}\p{N}_][\p{L}\p{N}\p{M}_]*(?:['’.][\p{L}\p{N}_][\p{L}\p{N}\p{M}_]*)*"

# Letters whose ASCII form no Unicode decomposition gives.
FOLD_TO_MANY = {"ß": "ss", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "þ": "th", "Þ": "TH"}
FOLD_TO_ONE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ħ": "h",
               "Ħ": "H", "ı": "i", "ŧ": "t", "Ŧ": "T"}


def _accented_letters() -> tuple[str, str]:
    """The accented Latin letters and, position by position, the letter under the accent."""
    pairs = dict(FOLD_TO_ONE)
    for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)):
        for letter in map(chr, block):
            bare = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
            if len(bare) == 1 and bare != letter and bare.isascii():
                pairs[letter] = bare
    return "".join(pairs), "".join(pairs.values())


ACCENTED, BARE = _accented_letters()


def strip(text: Column) -> Column:
    """Both ends cleared of every kind of white space, line ends included."""
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def occurrences(text: Column, term: str | Column) -> Column:
    """How often ``term`` occurs in ``text`` without overlap."""
    term = F.lit(term) if isinstance(term, str) else term
    return ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / F.length(term)).cast("int")


def tokens(text: Column) -> Column:
    """The words of ``text`` in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0))


def cut_apostrophe(token: Column) -> Column:
    """The part before the first apostrophe, straight or curled."""
    return F.substring_index(F.substring_index(token, "'", 1), "’", 1)


def _cut_apostrophes(text: Column) -> Column:
    """The same for every word of a text."""
    return F.regexp_replace(text, APOSTROPHE_TAIL, "$1")


def fold_accents(token: Column) -> Column:
    """Latin letters with accents, composed or not, become their ASCII letters."""
    token = F.regexp_replace(F.translate(token, ACCENTED, BARE), r"(?<=[A-Za-z])[\u0300-\u036f]+", "")
    for letter, plain in FOLD_TO_MANY.items():
        token = F.replace(token, F.lit(letter), F.lit(plain))
    return token


def normalize_token(token: Column) -> Column:
    """Apostrophe cut, accent folding and lower case, in that order."""
    return F.lower(fold_accents(cut_apostrophe(token)))


def is_kept(token: Column, stop_words: Iterable[str] = (), stop_after_lower: bool = False) -> Column:
    """The stop filter. It sees the raw token, so a capitalised stop word stays in by default."""
    words = list(stop_words)
    if not words:
        return F.lit(True)
    return ~(F.lower(token) if stop_after_lower else token).isin(words)


def analyze(text: Column, stop_words: Iterable[str] = (), stop_after_lower: bool = False,
            stem: bool = False) -> Column:
    """The whole chain on one text: array of index terms in text order."""
    stop_words = list(stop_words)
    if stop_words:
        found = F.filter(tokens(text), lambda t: is_kept(t, stop_words, stop_after_lower))
        terms = F.transform(found, normalize_token)
    else:
        # no filter needs the raw token: fold and shorten in the whole text, then cut it into words
        terms = tokens(_cut_apostrophes(F.lower(fold_accents(text))))
    if stem:
        from linkloom.functions.porter import stem_array

        terms = stem_array(terms)
    return terms
