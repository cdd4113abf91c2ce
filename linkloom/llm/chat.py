"""Chat formatting of reply trees.

Messages form trees: ``tree, node, parent, role, text, score``. Root-to-leaf paths are enumerated by
self-joins that double their reach each round, branches are ranked by score, and every chosen path becomes
one formatted conversation with the spans of the text that counts for the loss.

The template marks a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, in roles also a line break becomes ``\\n``; so no text can hold a mark, and
unescaping gives back exactly what was there.

Nulls: a null text or role is empty, a null tree is a tree of its own, a null parent or one that is missing
makes a root, a null score counts 0. Repeated turns of a conversation all stay, ordered by turn, role and text.
Parents that form a circle raise ``ValueError``. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import checkpoint

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(lines)


def turns_to_tree(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` as trees without branches: each turn answers the one before."""
    rows = rows.select(F.col("conv_id").alias("tree"), "turn", "role", "text")
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    at = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return at.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                     F.lit(0.0).alias("score"))


def paths(links: DataFrame) -> DataFrame:
    """``key, leaf, node, distance``: every node on the way from each leaf of ``key, node, parent`` to its root.

    Round k knows the 2^k-th ancestor of each node and all nodes of a path within 2^k of its leaf, so the
    rounds are as many as the logarithm of the depth.
    """
    node = links.select("key", "node")
    known = node.select("key", F.col("node").alias("up"))
    jump = checkpoint(links.filter("parent is not null").select("key", "node", F.col("parent").alias("up"))
                      .join(known, ["key", "up"], "left_semi"))
    parents = jump.select("key", F.col("up").alias("node")).distinct()
    path = node.join(parents, ["key", "node"], "left_anti").select(
        "key", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("distance"))
    path, reach, nodes, pairs = checkpoint(path), 1, links.count(), jump.count()
    if pairs and path.isEmpty():
        raise ValueError("messages that answer each other in a circle have no root")
    while pairs:
        if reach > nodes:
            raise ValueError("messages that answer each other in a circle have no root")
        further = path.join(jump, ["key", "node"]).select(
            "key", "leaf", F.col("up").alias("node"), (F.col("distance") + reach).alias("distance"))
        path = checkpoint(path.union(further))
        next_jump = jump.select("key", F.col("up").alias("node"), F.col("node").alias("low"))
        jump = checkpoint(next_jump.join(jump, ["key", "node"]).select("key", F.col("low").alias("node"), "up"))
        reach, pairs = reach * 2, jump.count()
    return path


def ranked(path: DataFrame, messages: DataFrame, branches: int | None) -> DataFrame:
    """``key, leaf, branch_score, branch``: branches of each tree by the summed score of their messages, ties by leaf."""
    scores = messages.select("key", "node", F.coalesce("score", F.lit(0.0)).alias("score"))
    total = path.join(scores, ["key", "node"]).groupBy("key", "leaf").agg(F.sum("score").alias("branch_score"))
    best = Window.partitionBy("key").orderBy(F.desc("branch_score"), "leaf")
    numbered = total.withColumn("branch", F.row_number().over(best))
    return numbered if branches is None else numbered.filter(F.col("branch") <= branches)


def conversations(messages: DataFrame, branches: int | None = None, loss_role: str = "assistant") -> DataFrame:
    """``tree, leaf, branch, branch_score, formatted, loss_spans``: one row per chosen root-to-leaf path.

    ``branches`` keeps the best so many of each tree; ``loss_spans`` lists start (from 0) and length, in code
    points of ``formatted``, of each text of ``loss_role``. A conversation is one string, hence one row.
    """
    messages = messages.select(
        "tree", F.to_json(F.struct("tree")).alias("key"), "node", "parent", "score",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    messages = checkpoint(messages)
    path = paths(messages.select("key", "node", "parent"))
    chosen = ranked(path, messages, branches)
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = (path.join(chosen, ["key", "leaf"]).join(messages.drop("score", "parent"), ["key", "node"])
             .withColumn("head", head).withColumn("body", escape(F.col("text")))
             .withColumn("turn", F.concat("head", "body", F.lit(END + "\n"))))
    before = Window.partitionBy("key", "leaf").orderBy(F.desc("distance")).rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.char_length("turn")).over(before), F.lit(0)) + F.char_length("head")
    span = F.when(F.col("role") == loss_role, F.struct(at.alias("start"), F.char_length("body").alias("length")))
    turns = turns.withColumn("span", span)
    whole = turns.groupBy("key", "leaf").agg(
        F.first("tree").alias("tree"), F.first("branch").alias("branch"), F.first("branch_score").alias("branch_score"),
        F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("at"), "turn", "span"))).alias("turns"))
    spans = F.filter(F.col("turns.span"), lambda s: s.isNotNull())
    return whole.select("tree", "leaf", "branch", "branch_score", F.array_join("turns.turn", "").alias("formatted"),
                        spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns in a formatted conversation: an array of ``role, text``."""
    turns = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def turn(part: Column) -> Column:
        part = F.substr(part, F.lit(len(START) + 1))
        cut = F.instr(part, F.lit("\n"))
        return F.struct(unescape_role(F.substr(part, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(part, cut + 1)).alias("text"))

    return F.transform(turns, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    parts = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"])))
    return F.array_join(parts, "")
