"""English suffix stripping after Porter (1980), with the two later changes (-bli, -logi) its author made."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffix tables of the published algorithm.
STEP_2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"),
          ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
          ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log")]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
          ("ness", "")]
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
          "ate", "iti", "ous", "ive", "ize"]


def _shape(word: str) -> str:
    """The word as v(owel) and c(onsonant) letters; y is a vowel after a consonant."""
    out = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _cvc_end(word: str) -> bool:
    return len(word) > 2 and _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


@lru_cache(maxsize=200_000)
def stem_word(word: str) -> str:
    """The stem of one lower-case word."""
    if len(word) < 3:
        return word
    # 1a plurals, 1b past and gerund, 1c final y
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = 2 if word.endswith("ed") else 3 if word.endswith("ing") else 0
        if cut and "v" in _shape(word[:-cut]):
            word = word[:-cut]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double_end(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _cvc_end(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    # 2 and 3 double suffixes, 4 single suffixes
    for table in (STEP_2, STEP_3):
        suffix = _longest(word, [s for s, _ in table])
        if suffix and _measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + dict(table)[suffix]
    suffix = _longest(word, STEP_4)
    if suffix:
        rest = word[: -len(suffix)]
        if _measure(rest) > 1 and (suffix != "ion" or rest.endswith(("s", "t"))):
            word = rest
    # 5 final e and double l
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _cvc_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def _stem_values(values: pa.Array) -> pa.Array:
    """Stem the distinct values of one batch and put them back in place."""
    coded = values.dictionary_encode()
    stems = pa.array([stem_word(w) for w in coded.dictionary.to_pylist()], pa.string())
    return stems.take(coded.indices)


# Both functions below are declared not deterministic so that Spark never evaluates them a second
# time for a filter it pushes under the projection.


@F.arrow_udf(T.StringType())
def stem(terms: pa.Array) -> pa.Array:
    """Stems of a column of terms."""
    return _stem_values(terms.cast(pa.string()))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_array(terms: pa.Array) -> pa.Array:
    """Stems of a column of term arrays, one call of the stemmer per distinct term of a batch."""
    flat = terms.flatten().cast(pa.string())
    lengths = terms.value_lengths().fill_null(0)
    ends = pc.cumulative_sum(lengths).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, _stem_values(flat), mask=terms.is_null())


stem = stem.asNondeterministic()
stem_array = stem_array.asNondeterministic()
