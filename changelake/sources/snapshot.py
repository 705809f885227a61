"""Bounded table reads in ranges."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.records import add_cdc_metadata

# Pages per range, rows per fetch.
PAGES_PER_CHUNK = 500
FETCH_SIZE = 5000

# Pages of 8 KB that make a file of 256 MB: what a load over JDBC takes as one range, task and file.
PAGES_PER_FILE = 32_768

# Ranges are listed in two steps so that no single array grows with the table.
_LISTED_AT_ONCE = 1000


class Chunks(NamedTuple):
    """Ranges of equal width over an integer key, numbered from 0.

    The first range also takes what lies below `lower` and null keys, the last one whatever lies
    above: bounds may be estimates, and rows beyond them are read all the same.
    """

    key: str
    lower: int
    width: int
    count: int

    def of(self) -> Column:
        """The range a row belongs to."""
        nth = F.expr(f"(`{self.key}` - {self.lower}L) div {self.width}L")
        # Dividing rounds toward zero, so keys just below `lower` land in range 0 as well.
        inside = F.least(F.greatest(nth, F.lit(0)), F.lit(self.count - 1))
        return F.coalesce(inside, F.lit(0)).cast("int")

    def between(self, first: int, last: int) -> Column:
        """Condition of the ranges first..last on the bare key, so that scans can use it."""
        key, condition = F.col(self.key), F.lit(first <= last)
        if first >= self.count:
            return F.lit(False)
        if first > 0:
            condition = condition & (key >= self.lower + first * self.width)
        if last < self.count - 1:
            below = key < self.lower + (last + 1) * self.width
            condition = condition & (below if first > 0 else below | key.isNull())
        return condition


def chunk_plan(tables: DataFrame, pages_per_chunk: int = PAGES_PER_CHUNK) -> DataFrame:
    """Half-open page ranges of tables given with their `pages`; an empty table has one range."""
    width = int(pages_per_chunk)
    last = F.greatest(F.ceil(F.col("pages") / width), F.lit(1)) - 1
    return (
        tables.withColumn("_last", last)
        .withColumn("_group", F.explode(F.sequence(F.lit(0), "_last", F.lit(_LISTED_AT_ONCE))))
        .withColumn(
            "chunk",
            F.explode(
                F.sequence("_group", F.least(F.col("_group") + _LISTED_AT_ONCE - 1, "_last"))
            ),
        )
        .withColumn("start_page", F.col("chunk") * width)
        .withColumn("end_page", F.least(F.col("start_page") + width, F.col("pages") + 1))
        .drop("_last", "_group")
    )


def page_chunks(key: str, pages: int, pages_per_chunk: int = PAGES_PER_CHUNK) -> Chunks:
    """The same ranges as `chunk_plan` for one table, by number of pages."""
    return Chunks(key, 0, pages_per_chunk, max(-(-pages // pages_per_chunk), 1))


def key_chunks(df: DataFrame, key: str, width: int) -> Chunks:
    """Ranges over a key column, where a table has no page count."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return Chunks(key, 0, width, 1)
    return Chunks(key, low, width, (high - low) // width + 1)


class Cuts(NamedTuple):
    """Ranges between cut values of a key, numbered from 0.

    Range n starts above cut n - 1, or at it where that is marked as `at`, and goes on to the next cut. Null keys are in the first range.
    """

    key: str
    values: tuple
    at: tuple[bool, ...]

    @property
    def count(self) -> int:
        return len(self.values) + 1

    def _beyond(self, value: Column, at: Column | bool) -> Column:
        key = F.col(self.key)
        return (key > value) | ((key == value) & (at if isinstance(at, Column) else F.lit(at)))

    def of(self) -> Column:
        """The range a row belongs to: looked up among every so many cuts first, then between two of these."""
        step = max(int(self.count**0.5), 1)
        cuts = [F.struct(F.lit(v).alias("v"), F.lit(a).alias("a")) for v, a in zip(self.values, self.at)]
        if not cuts:
            return F.lit(0)
        parts = [F.array(*cuts[i : i + step]) for i in range(0, len(cuts), step)]
        below = lambda array: F.size(F.filter(array, lambda c: F.coalesce(self._beyond(c["v"], c["a"]), F.lit(False))))
        part = below(F.array(*cuts[::step])) - 1
        return F.when(part < 0, 0).otherwise(part * step + below(F.get(F.array(*parts), part))).cast("int")

    def between(self, first: int, last: int) -> Column:
        """Condition of the ranges first..last on the bare key, so that scans can use it."""
        condition, key = F.lit(first <= last), F.col(self.key)
        if first >= self.count:
            return F.lit(False)
        if first > 0:
            low = F.lit(self.values[first - 1])
            condition &= key >= low if self.at[first - 1] else key > low
        if last < self.count - 1:
            high = F.lit(self.values[last])
            below = key < high if self.at[last] else key <= high
            condition &= below if first > 0 else below | key.isNull()
        return condition


# Quantiles looked at for each range wanted, and how much finer than these the sketch is.
QUANTILES, FINER = 4, 8


def quantile_chunks(df: DataFrame, key: str, ranges: int) -> Cuts:
    """About so many ranges of equal row counts over a number or time column, however its values are spread.

    One aggregation builds quantile sketches that merge; the driver gets a few values for each range. A value that fills a range
    by itself gets one of its own, which may be as large as that value is frequent; the others hold at most twice their share, and little or nothing
    where they lie between such values. An empty table has one range.
    """
    points = ranges * QUANTILES
    wanted = [i / points for i in range(1, points)]
    found = df.agg(F.percentile_approx(key, wanted, points * FINER)).first()[0] if points > 1 else None
    values, at = [], []

    def cut(value, starts: bool) -> None:
        if not values or (values[-1], at[-1]) != (value, starts):
            values.append(value)
            at.append(starts)

    runs: list[list] = []
    for v in found or []:
        if runs and runs[-1][0] == v:
            runs[-1][1] += 1
        else:
            runs.append([v, 1])
    filled = 0
    for v, n in runs:
        if n >= QUANTILES:
            cut(v, True)
            cut(v, False)
            filled = 0
        else:
            filled += n
            if filled >= QUANTILES:
                cut(v, False)
                filled = 0
    return Cuts(key, tuple(values), tuple(at))


def snapshot_scan(df: DataFrame, columns: Iterable[str], ingest_ts: Column) -> DataFrame:
    """The declared columns of a table, each row tagged as part of a snapshot at position 0."""
    rows = df.select(*columns).withColumn("_cdc_position", F.lit(0).cast("bigint"))
    return add_cdc_metadata(rows, F.lit("SNAPSHOT"), ingest_ts)


def chunked_snapshot(df: DataFrame, chunks: Chunks | Cuts) -> DataFrame:
    """Tag each row of a file table with its range; the files' own splits run in parallel."""
    return df.withColumn("chunk", chunks.of())


def snapshot_resume(df: DataFrame, chunks: Chunks | Cuts, done: int) -> DataFrame:
    """The rows of the ranges that are not done yet, as a condition the scan can prune with."""
    return df.filter(chunks.between(done, chunks.count - 1))


def ctid_predicates(chunks: Chunks, first: int, last: int) -> list[str]:
    """One physical range condition per chunk first..last; the table's last one is open."""
    out = []
    for n in range(first, min(last, chunks.count - 1) + 1):
        start = chunks.lower + n * chunks.width
        low = f"ctid >= '({start},0)'::tid"
        high = f" AND ctid < '({start + chunks.width},0)'::tid"
        out.append(low + (high if n < chunks.count - 1 else ""))
    return out
