"""Tables that only grow, wave by wave, held in few parts whatever the number of waves."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import checkpoint, partitions_for

WAVE = "_wave"


@dataclass(frozen=True)
class Part:
    rows: DataFrame  # the table's columns and the wave that added a row
    size: int
    last: int  # the latest wave in it


@dataclass(frozen=True)
class GrowingTable:
    """Rows added by waves, in written parts of which each is more than twice as large as the next.

    A new part takes in the parts before it that are not, so n rows are in at most log n parts, a plan over them has as
    many branches, and a row is rewritten log n times however many waves there are. With ``total`` the rows are partial
    sums of that column by ``key``, and parts that meet become one row per key. Nothing is dropped; equal rows stay.
    """

    parts: tuple[Part, ...] = ()
    key: str | None = None
    total: str | None = None

    def add(self, rows: DataFrame, wave: int, written: bool = False) -> GrowingTable:
        """The table with one wave's rows; a wave without rows adds no part, but for the first, which brings the columns.

        Rows ``written`` before, a column choice of a checkpoint or a stored table, are not written again.
        """
        rows = rows if written else checkpoint(rows)
        new = Part(rows.withColumn(WAVE, F.lit(wave)), rows.count(), wave)
        if self.parts and not new.size:
            return self
        parts, merged = list(self.parts), [new]
        while parts and parts[-1].size <= 2 * sum(p.size for p in merged):
            merged.append(parts.pop())
        return GrowingTable((*parts, self._merged(merged)), self.key, self.total)

    def _merged(self, parts: list[Part]) -> Part:
        if len(parts) == 1:
            return parts[0]
        both = reduce(DataFrame.unionByName, (p.rows for p in parts))
        size = sum(p.size for p in parts)
        if self.total:
            both = checkpoint(both.groupBy(self.key).agg(F.sum(self.total).alias(self.total), F.max(WAVE).alias(WAVE)))
            size = both.count()
        else:
            # a few tasks of a plain copy, no shuffle
            both = checkpoint(both.coalesce(max(partitions_for(both.sparkSession, size), 1)))
        return Part(both, size, max(p.last for p in parts))

    def rows(self, after: int = -1) -> DataFrame:
        """What was added later than wave ``after``, by default everything; parts without such rows are not read."""
        if self.total and after >= 0:
            raise ValueError("sums of several waves cannot be told apart")
        chosen = [p.rows for p in self.parts if p.last > after] or [self.parts[0].rows]
        table = reduce(DataFrame.unionByName, chosen)
        return (table if after < 0 else table.filter(F.col(WAVE) > after)).drop(WAVE)

    def sums_of(self, keys: DataFrame) -> DataFrame:
        """``key, total`` for the keys of a narrow table; only sums of these keys are moved."""
        found = reduce(DataFrame.unionByName, (p.rows.join(keys, self.key, "left_semi") for p in self.parts))
        return found.groupBy(self.key).agg(F.sum(self.total).alias(self.total))
