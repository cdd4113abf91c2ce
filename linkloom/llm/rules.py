"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps its measurements and one failure bit per rule.
Policies are versioned masks over the bits, applied later without touching a text, and ablations of a policy
are bitwise aggregates of the ledger. Only column expressions are used.

A null or empty text has no words and fails the first rule. Rows are judged one by one, so repeated rows and
texts of any length are treated alike. A ledger has the columns of its table and the measurements, which take the place
of columns with their names; :func:`accepted` gives the rows of a table back with all columns as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
GAP = r"[ \t-\r]+"
WINDOW = 5

#: Name and condition of failure, in the order of the bits. Bits are never reused for another rule.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    ("upper_case", "100 * n_upper > 25 * word_chars"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
)
BASE = ("few_words", "repeated_windows")
#: A policy lists the rules whose failure rejects a document.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines", "upper_case", "word_length"),
}
LATEST = max(POLICIES)


def mask(rules: tuple[str, ...]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_repeat_words", "failed", "kept")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements. The helper columns are referred to often enough that Spark keeps them apart."""
    taken = [c for c in docs.columns if c.lower() in MEASURES]
    own = F.struct("*").dropFields(*taken) if taken else F.struct("*")
    text = F.coalesce(F.col("text"), F.lit(""))
    body = F.btrim(text, F.lit(WHITE))
    # the table's own columns travel as one, so that no name meets a helper's
    df = docs.select(own.alias("_row"), "text").withColumn("_body", body)
    df = df.withColumn("_words", F.when(F.col("_body") == "", F.array().cast("array<string>"))
                       .otherwise(F.split("_body", GAP)))
    df = df.withColumn("_lines", F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != ""))
    words = F.col("_words")
    # the hash of each window of words; the places run along the words, so no window is built as a string
    windows = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_windows", windows)
    joined = F.array_join("_words", "")
    df = df.select(
        "_row", F.size("_words").cast("long").alias("n_words"), F.char_length(joined).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count("_body", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        "_windows", (F.size("_windows") > F.size(F.array_distinct("_windows"))).alias("_again"))
    found = F.when(F.col("_again"), F.sort_array(F.transform(
        F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_sorted", found)
    repeated = F.when(F.col("_again"), covered(F.col("_sorted"))).otherwise(F.lit(0)).cast("long")
    return df.select("_row.*", *MEASURES[:6], repeated.alias("n_repeat_words"))


def covered(found: Column) -> Column:
    """Words in windows whose hash stands twice or more in the sorted array of ``h`` and place ``i``."""

    def same(i: Column, j: Column) -> Column:
        return F.coalesce(F.get(found, i)["h"] == F.get(found, j)["h"], F.lit(False))

    places = F.sequence(F.lit(0), F.size(found) - 1)
    twice = F.filter(places, lambda i: same(i, i - 1) | same(i, i + 1))
    starts = F.sort_array(F.transform(twice, lambda i: F.get(found, i)["i"]))
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(starts, begin, lambda s, p: F.struct(
        (s["n"] + p + WINDOW - F.greatest(p, s["end"])).alias("n"), (p + WINDOW).alias("end")), lambda s: s["n"])


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements and ``failed``, the bits of the rules it fails."""
    bits = None
    for at, (_, condition) in enumerate(RULES):
        bit = F.when(F.expr(condition), F.lit(1 << at)).otherwise(F.lit(0))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    # the condition always holds, and keeps Spark from moving a filter on the bits below the measurements
    return measured(docs).withColumn("failed", F.when(F.monotonically_increasing_id() >= 0, bits))


def apply_policy(ledger_rows: DataFrame, version: int = LATEST) -> DataFrame:
    """``kept`` under one version of the policy."""
    return ledger_rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def accepted(docs: DataFrame, version: int = LATEST) -> DataFrame:
    """The rows of ``docs`` that one version of the policy keeps, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return apply_policy(ledger(rows), version).filter("kept").select("row.*")


def ablation(ledger_rows: DataFrame, version: int = LATEST) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail only it, and that would stay without it.

    The documents are first counted by their failure bits; what follows is over one row per set of bits.
    """
    policy = mask(POLICIES[version])
    sets = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy)).alias("bits")).agg(F.count("*").alias("n"))
    each = []
    for rule in POLICIES[version]:
        bit = mask((rule,))
        fails = F.sum(F.when(F.col("bits").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0))
        alone = F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(0))
        without = F.sum(F.when(F.col("bits").bitwiseAND(F.lit(policy & ~bit)) == 0, F.col("n")).otherwise(0))
        each.append(F.struct(F.lit(rule).alias("rule"), F.coalesce(fails, F.lit(0)).alias("n_fail"),
                             F.coalesce(alone, F.lit(0)).alias("n_only"),
                             F.coalesce(without, F.lit(0)).alias("n_kept_without")))
    return sets.agg(F.array(*each).alias("rules")).select(F.inline("rules"))
