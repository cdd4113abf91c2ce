"""Line dedup: every line that another document with a smaller id has too is dropped; the result is a bitmap of kept lines.

Lines are compared by a key, the line without white space at its ends and with ``A-Z`` in lower case. Keys of at least
``LEAST`` code points count; two hashes of 64 bits stand for one. The hashes are partitioned by range and sorted by
document and position within, so the first document of a hash is streamed along its lines. A hash found too often for
one sorted run is looked up in a table of first documents instead: at most ``MOST_HOT`` hashes can be that frequent.
Texts are not moved for this, and what comes back for each document is its kept lines as runs, a run-length bitmap.

A null text is one empty line. A null id counts as larger than all others. Rows with equal ids are one document: their
lines are kept alike. Rows equal in id and text get equal results. Other columns are ignored by :func:`keep_bitmaps` and
kept by :func:`deduplicated`, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import MAX_ID, saved, unused

WHITE = " \t\n\x0b\f\r"
LEAST = 10
RUN_ROWS = 1 << 10  # a hash with more lines is hot; the number grows with the table
MOST_HOT = 1 << 16
ROWS_PER_RANGE = 1 << 20


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def document(docs: DataFrame) -> list[Column]:
    """What tells documents apart: ``id``, a long and never null, and ``text_hash``."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_ID)).alias("id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def line_hashes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``id, text_hash, pos, h1, h2`` of every line whose key is long enough."""
    lines = docs.select(*document(docs), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("line")).filter(
        F.char_length("line") >= least)
    return keys.select("id", "text_hash", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def dropped_lines(hashes: DataFrame, run_rows: int = RUN_ROWS, ranges: int | None = None) -> DataFrame:
    """``id, text_hash, pos`` of the lines that a document with a smaller id has; ``hashes`` is a written table."""
    n = hashes.count()
    run_rows = max(run_rows, n // MOST_HOT)
    counted = hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    # at most n / run_rows hashes come so often
    hot = F.broadcast(saved(counted.filter(F.col("n") > run_rows).select("h1", "h2", "first"), "lines-hot"))
    later = hashes.join(hot, ["h1", "h2"]).filter("id > first")
    rest = hashes.join(hot, ["h1", "h2"], "left_anti")
    ranges = ranges or max(8, n // ROWS_PER_RANGE)
    in_order = rest.repartitionByRange(ranges, "h1", "h2").sortWithinPartitions("h1", "h2", "id", "pos")
    so_far = Window.partitionBy("h1", "h2").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = in_order.withColumn("first", F.first("id").over(so_far)).filter("id > first")
    return later.select("id", "text_hash", "pos").union(streamed.select("id", "text_hash", "pos"))


def kept_runs(dropped: Column, n_lines: Column) -> Column:
    """Runs ``start, length`` of kept lines, from the sorted positions of dropped ones."""
    begins = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    ends = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != p + 1))
    runs = F.zip_with(
        F.concat(F.array(F.lit(-1)), ends), F.concat(begins, F.array(n_lines)),
        lambda end, begin: F.struct((end + 1).alias("start"), (begin - end - 1).alias("length")))
    return F.filter(runs, lambda run: run["length"] > 0)


def bitmaps(docs: DataFrame, least: int = LEAST, **how) -> DataFrame:
    """``id, text_hash, dropped``: the sorted positions of dropped lines, for documents that lose any."""
    rows = dropped_lines(saved(line_hashes(docs, least), "lines-hashes"), **how)
    return rows.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def with_bitmaps(docs: DataFrame, name: str, least: int = LEAST, **how) -> DataFrame:
    """``docs`` with ``name``, a struct of ``n_lines, n_dropped`` and the kept ``runs`` of each row."""
    i, h, d, n = unused(docs, "id", "text_hash", "dropped", "n_lines")
    own = [c.alias(x) for c, x in zip(document(docs), (i, h))]
    found = bitmaps(docs.select("doc_id", "text"), least, **how).toDF(i, h, d)
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    rows = docs.select("*", *own).join(found, [i, h], "left").withColumn(n, lines)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col(n).alias("length")))
    keep = F.struct(
        F.col(n).cast("long").alias("n_lines"), F.coalesce(F.size(d), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col(d).isNull(), whole).otherwise(kept_runs(F.col(d), F.col(n))).alias("runs"))
    return rows.withColumn(name, keep).select(*docs.columns, name)


def keep_bitmaps(docs: DataFrame, least: int = LEAST, **how) -> DataFrame:
    """``doc_id, n_lines, n_dropped, runs`` of every row."""
    (name,) = unused(docs, "keep")
    return with_bitmaps(docs.select("doc_id", "text"), name, least, **how).select("doc_id", f"{name}.*")


def kept_text(text: Column, runs: Column) -> Column:
    """The kept lines of a text."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")


def deduplicated(docs: DataFrame, least: int = LEAST, **how) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; a text that loses none stays as it is, null too."""
    (name,) = unused(docs, "keep")
    kept = F.when(F.col(f"{name}.n_dropped") == 0, F.col("text")).otherwise(kept_text(F.col("text"), F.col(f"{name}.runs")))
    return with_bitmaps(docs, name, least, **how).withColumn("text", kept).select(docs.columns)
