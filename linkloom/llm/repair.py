"""Repair of the turn structure of conversations, by Wagner-Fischer alignment to strings of a grammar.

The initials of a conversation's roles should read ``(s?(ua)+)?``. Every feasible length has one or no such string, and
the turns are aligned to it: a turn is kept, given another role or deleted, and empty turns are inserted. The table of
an alignment is filled within an Ukkonen band, as wide as the cost of the best alignment so far allows; a length whose
difference alone costs more is left out. Among the cheapest edits the audit, their initials in order, that comes first
in ASCII order is taken: one is traced back for every length that ties. Turns that must go take no part in the tables;
their deletions stand before the insertions of their gap, where the order puts them.

A conversation of more than ``LONGEST`` turns to align has its lengths folded: as only the next letter wanted matters
for what is left, one column for each such state stands for all lengths, which takes linear time and gives the same
edits (tested against the tables).

Rows are ordered by turn, nulls first, and then by role and text, so a copy stands beside its turn. Null texts and roles
are one space; a null conversation id is a conversation of its own. Rows that repeat are duplicate turns. Other columns
are ignored. One conversation at a time is held, without the text of turns that must go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from linkloom.llm.common import hand_back

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LONGEST = 256
FLUSH_BYTES = 1 << 23
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\f\r"
NEVER = 1 << 60
COLUMNS = ("{name} {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired array<struct<role:string,text:string>>")


def target(length: int) -> str:
    """The string of the grammar with this length; there is none of length 1."""
    return "s" * (length % 2) + "ua" * (length // 2)


def aligned(kinds: str, extra: list[int], wanted: str, limit: int) -> tuple[int, str] | None:
    """Cost and first audit of the cheapest edits from ``kinds`` to ``wanted``, or None if above ``limit``.

    ``extra`` is what a turn costs unless it is deleted.
    """
    n, m = len(kinds), len(wanted)
    inserts = (limit - DELETE * (n - m)) // (DELETE + INSERT)  # no path within the limit has more
    deletes = inserts + n - m
    if inserts < 0 or deletes < 0:
        return None
    rest = [[NEVER] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        own = rest[i]
        below = rest[i + 1] if i < n else None
        for j in range(min(m, i + inserts), max(0, i - deletes) - 1, -1):
            best = 0 if i == n and j == m else NEVER
            if i < n:
                best = min(best, DELETE + below[j])
                if j < m and (kinds[i] == wanted[j] or wanted[j] != "s"):
                    best = min(best, (kinds[i] != wanted[j]) * REROLE + extra[i] + below[j + 1])
            if j < m and wanted[j] != "s":
                best = min(best, INSERT + own[j + 1])
            own[j] = best
    if rest[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = rest[i][j]
        if i < n and left == DELETE + rest[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and wanted[j] != "s" and left == INSERT + rest[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if kinds[i] == wanted[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


def tabled(kinds: str, extra: list[int]) -> tuple[int, str]:
    """Cost and audit over all feasible lengths, nearest first."""
    n = len(kinds)
    cost, audit = DELETE * n, "D" * n
    lengths = [m for m in range(2, n + cost // INSERT + 1)]
    for m in sorted(lengths, key=lambda m: (abs(m - n), m)):
        if max(DELETE * (n - m), INSERT * (m - n)) > cost:
            continue
        found = aligned(kinds, extra, target(m), cost)
        if found is not None:
            cost, audit = min((cost, audit), found)
    return cost, audit


#: What a state wants next: the start, the user after a system turn, a user who may also be missing, an assistant.
START, FIRST, USER, ASSISTANT = range(4)
ENDS = ((0, ""), (2 * INSERT, "I"), (0, ""), (INSERT, "I"))


def folded(kinds: str, extra: list[int]) -> tuple[int, str]:
    """The same for long conversations, with one column for each state."""
    rest = [cost for cost, _ in ENDS]
    letters = [tuple(letter for _, letter in ENDS)]
    for kind, more in zip(reversed(kinds), reversed(extra)):
        options = []
        for state in range(4):
            wants = "a" if state == ASSISTANT else "u"
            to = USER if state == ASSISTANT else ASSISTANT
            own = [(DELETE + rest[state], "D")]
            own.append((more + rest[to], "K") if kind == wants else (REROLE + more + rest[to], "R"))
            if state == START and kind == "s":
                own.append((more + rest[FIRST], "K"))
            options.append(min(own))
        plain = list(options)
        options[USER] = min(plain[USER], (INSERT + plain[ASSISTANT][0], "I"))
        options[ASSISTANT] = min(plain[ASSISTANT], (INSERT + plain[USER][0], "I"))
        for state in (START, FIRST):
            options[state] = min(plain[state], (INSERT + options[ASSISTANT][0], "I"))
        rest = [cost for cost, _ in options]
        letters.append(tuple(letter for _, letter in options))
    audit, state, left = [], START, len(kinds)
    while left or letters[0][state]:
        letter = letters[left][state]
        audit.append(letter)
        if letter == "K" and state == START and kinds[len(kinds) - left] == "s":
            state = FIRST
        elif letter != "D":
            state = USER if state == ASSISTANT else ASSISTANT
        left -= letter != "I"
    return rest[START], "".join(audit)


def repaired(rows: list[tuple]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, audit and the repaired turns; ``rows`` are ``role, text, must go, truncated`` in order."""
    free = [k for k, row in enumerate(rows) if not row[2]]
    kinds = "".join([rows[k][0][:1] if rows[k][0][:1] in ("s", "u", "a") else "-" for k in free])
    extra = [TRUNCATED * rows[k][3] for k in free]
    cost, edits = (tabled if len(free) <= LONGEST else folded)(kinds, extra)
    wanted = target(len(edits) - edits.count("D"))
    audit, out, at, j = [], [], 0, 0
    for edit in edits:
        while at < len(rows) and rows[at][2]:
            audit.append("D")
            at += 1
        audit.append(edit)
        if edit == "I":
            out.append((ROLES[wanted[j]], ""))
        elif edit != "D":
            role, text = rows[at][:2]
            out.append((role if edit == "K" else ROLES[wanted[j]], text))
        j += edit != "D"
        at += edit != "I"
    audit.append("D" * (len(rows) - at))
    return cost + DELETE * (len(rows) - len(free)), "".join(audit), out


class Conversation:
    """The rows of one conversation as they come in."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.rows: list[tuple] = []
        self.turns: set[int] = set()
        self.seen: set[tuple[str, str]] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last: str | None = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns.add(turn)
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        solid = text.rstrip(WHITE)
        blank = not solid
        duplicate = not blank and (role, text) in self.seen
        truncated = not blank and not duplicate and solid[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if blank or duplicate:
            self.rows.append(("", "", True, False))
        else:
            self.seen.add((role, text))
            self.rows.append((role, text, False, truncated))

    def result(self) -> tuple:
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        cost, audit, turns = repaired(self.rows)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit,
                [{"role": r, "text": t} for r, t in turns])


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired`` of every conversation.

    ``turns`` has ``conv_id, turn, role, text``; ``copies`` names a column that says how often a row stands there,
    and a conversation whose rows all stand there 0 times is repaired as an empty one.
    """
    times = F.col(copies).cast("int") if copies else F.lit(1)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        times.alias("times"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    rows = rows.repartition("conv_id").sortWithinPartitions(*order)
    schema = T._parse_datatype_string(COLUMNS.format(name="conv_id", kind=turns.schema["conv_id"].dataType.simpleString()))
    arrow = to_arrow_schema(schema)

    def table(results: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*results), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, size = None, [], 0
        for batch in batches:
            for conv_id, turn, role, text, n in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held.conv_id != conv_id:
                    if held is not None:
                        done.append(held.result())
                    held = Conversation(conv_id)
                for _ in range(n):
                    held.add(turn, role, text)
                size += len(text)
            if done and size >= FLUSH_BYTES:
                yield table(done)
                done, size = [], 0
        if held is not None:
            done.append(held.result())
        if done:
            yield table(done)
        hand_back()

    return rows.mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows with faults that a checksum of id and turn decides on.

    Of 20 remainders, 0 drops the row (no copies), 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 gives it to the user. Nulls are one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault <= 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))
