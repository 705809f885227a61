"""Rows that are new by a cursor column."""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Mark(NamedTuple):
    """How far a table has been read: the highest cursor value, and how many rows below it were."""

    value: Any
    below: int


def cursor_increment(rows: DataFrame, cursor: str, ids: list[str], mark: Mark | None, seen: DataFrame | None, high: Any) -> DataFrame:
    """The rows beyond the mark, up to `high`.

    At the mark itself are rows that were there before and rows that came since; `seen` has the ids of the former. Rows
    without a cursor value are never new.
    """
    upto = rows.filter(F.col(cursor) <= F.lit(high))
    if mark is None:
        return upto
    tied = upto.filter(F.col(cursor) == F.lit(mark.value))
    if seen is not None:
        same = F.lit(True)
        before = seen.select(*[F.col(i).alias(f"_{i}") for i in ids])
        for i in ids:
            same &= F.col(i).eqNullSafe(F.col(f"_{i}"))
        tied = tied.join(before, same, "left_anti").select(rows.columns)
    return upto.filter(F.col(cursor) > F.lit(mark.value)).unionByName(tied)


def passed_over(rows: DataFrame, cursor: str, mark: Mark | None) -> DataFrame:
    """One row: `late`, rows below the mark beyond those that were there when it was set, and `no_cursor`, those without a value.

    Both were not read and won't be. Rows deleted below the mark make up for late ones.
    """
    below = F.count(F.when(F.col(cursor) < F.lit(mark.value), 1)) - mark.below if mark else F.lit(0)
    return rows.agg(below.cast("bigint").alias("late"), F.count(F.when(F.col(cursor).isNull(), 1)).alias("no_cursor"))
