"""Sets of places in streams as intervals.

A set is a frame of keys, `seq_from` and `seq_to` (both within), and the first and last marker among its places, `first_mark` and
`last_mark` (null where there is none). Intervals of one set don't overlap. It grows with the gaps between places, not with the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.operators.ordered import BLOCK_WIDTH, UPPER_WIDTH, _block, carried_forward


def islands(places: DataFrame, keys: list[str], order: str, mark: Column, width: int = BLOCK_WIDTH) -> DataFrame:
    """The places, unique for their keys, as intervals. They are found block by block, so intervals end where blocks do."""
    rows = places.select(*keys, F.col(order).alias("_seq"), mark.alias("_mark"), _block(order, width).alias("_block"))
    number = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy("_seq"))
    at_mark = F.when(F.col("_mark").isNotNull(), F.col("_seq"))
    found = rows.withColumn("_island", F.col("_seq") - number).groupBy(*keys, "_block", "_island").agg(
        F.min("_seq").alias("seq_from"), F.max("_seq").alias("seq_to"),
        F.min_by("_mark", at_mark).alias("first_mark"), F.max_by("_mark", at_mark).alias("last_mark"),
    )
    return found.drop("_block", "_island")


def merged(intervals: DataFrame, keys: list[str], width: int = BLOCK_WIDTH) -> DataFrame:
    """The same set with intervals that touch each other made one."""
    # Ends stand after their starts, and before the start that follows.
    starts = intervals.withColumns({"_at": 2 * F.col("seq_from"), "_end": F.lit(None).cast("bigint")})
    ends = intervals.select(*keys, (2 * F.col("seq_to") + 1).alias("_at"), F.col("seq_to").alias("_end"))
    rows = carried_forward(starts.unionByName(ends, allowMissingColumns=True), keys, "_at", {"_before": F.col("_end")}, width)
    rows = rows.filter(F.col("_end").isNull())
    begins = F.when(F.col("_before").isNull() | (F.col("_before") + 1 < F.col("seq_from")), F.col("seq_from"))
    rows = carried_forward(rows, keys, "_at", {"_begun": begins}, width)
    first = F.when(F.col("first_mark").isNotNull(), F.col("seq_from"))
    return rows.groupBy(*keys, "_begun").agg(
        F.min("seq_from").alias("seq_from"), F.max("seq_to").alias("seq_to"),
        F.min_by("first_mark", first).alias("first_mark"), F.max_by("last_mark", first).alias("last_mark"),
    ).drop("_begun")


def outside(
    rows: DataFrame, intervals: DataFrame, keys: list[str], order: str, width: int = BLOCK_WIDTH, upper_width: int | None = UPPER_WIDTH,
    size: int | None = None,
) -> DataFrame:
    """The rows whose place is in none of the intervals."""
    placed = rows.withColumns({"_at": 2 * F.col(order) + 1, "_ends": F.lit(None).cast("bigint"), "_is_row": F.lit(True)})
    starts = intervals.select(*keys, (2 * F.col("seq_from")).alias("_at"), F.col("seq_to").alias("_ends"))
    found = carried_forward(placed.unionByName(starts, allowMissingColumns=True), keys, "_at", {"_upto": F.col("_ends")}, width, upper_width, size)
    return found.filter(F.col("_is_row") & (F.col("_upto").isNull() | (F.col("_upto") < F.col(order)))).select(rows.columns)


def border_marks(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The markers that lie nearest to the gaps between intervals, each with its fields and keys."""
    marks = F.array_compact(F.array_distinct(F.array("first_mark", "last_mark")))
    return intervals.select(*keys, F.inline(marks))
