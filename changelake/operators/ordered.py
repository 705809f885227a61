"""Ordered work without giant windows.

A window over a whole stream runs in one task. The functions here use that the order column of a
stream is a unique integer (a sequence number or an offset): rows are cut into blocks of `width`
consecutive order values, so a block holds a bounded number of rows whatever the skew. Windows
run inside blocks; what crosses a block border is computed on one row per block, and over many blocks
in the same way once more: inside blocks of blocks, and on one row for each of these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_WIDTH = 65_536
# Blocks in a block of blocks.
UPPER_WIDTH = 65_536
# Rows that one task sorts, about.
ROWS_OF_PART = 262_144


def _block(order: str, width: int) -> Column:
    # floor division in integers: a block never mixes negative and positive order values
    return F.expr(f"(`{order}` - pmod(`{order}`, {width}L)) div {width}L")


def _same(keys: list[str], other: str) -> Column:
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"{other}{c}"))
    return same


def parts_for(rows: int, spark: SparkSession) -> int | None:
    """How many partitions keep each at about ROWS_OF_PART rows; None where the cores alone do, and adaptive execution may choose."""
    return None if rows <= ROWS_OF_PART * spark.sparkContext.defaultParallelism else -(-rows // ROWS_OF_PART)


def _in_blocks(rows: DataFrame, keys: list[str], order: str, width: int, size: int | None) -> DataFrame:
    """The rows by `_place`, their block and keys: one value that is never null, so that windows, groups and joins share one shuffle.

    Partitions have a bounded number of rows, however many there are in all: `size`, counted if it is not given.
    """
    parts = parts_for(rows.count() if size is None else size, rows.sparkSession)
    rows = rows.withColumn("_place", F.struct(_block(order, width).alias("_block"), *keys))
    return rows.repartition(parts, "_place") if parts else rows.repartition("_place")


def _borders(
    blocks: DataFrame, keys: list[str], forward: list[str], backward: list[str] = (), upper_width: int | None = UPPER_WIDTH
) -> DataFrame:
    """For each block (`_place`) what crosses its borders, its place renamed to `_of_place`.

    Of a `forward` column the last value (not null) of the blocks before it, of a `backward` column
    the first of those after it. Without an `upper_width` all blocks of a key are in one window.
    """
    def windows(place: list[str], order: str):
        over = Window.partitionBy(place)
        up = over.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        down = over.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
        return {c: F.last(c, True).over(up) for c in forward} | {c: F.last(c, True).over(down) for c in backward}

    blocks = blocks.select("_place.*", *forward, *backward)
    place = F.struct("_block", *keys).alias("_of_place")
    if upper_width is None:
        return blocks.select(place, *[c.alias(n) for n, c in windows(keys, "_block").items()])
    upper = keys + ["_upper"]
    # Shuffled before they are read twice, so blocks are made once.
    blocks = blocks.withColumn("_upper", _block("_block", upper_width)).repartition(*upper)
    filled = lambda c: F.when(F.col(c).isNotNull(), F.col("_block"))
    uppers = blocks.groupBy(upper).agg(
        *[F.max_by(c, filled(c)).alias(c) for c in forward], *[F.min_by(c, filled(c)).alias(c) for c in backward]
    )
    above = uppers.select(
        *[F.col(c).alias(f"_up_{c}") for c in upper], *[c.alias(f"_above_{n}") for n, c in windows(keys, "_upper").items()]
    )
    return blocks.join(above, _same(upper, "_up_")).select(
        place,
        *[F.coalesce(c, F.col(f"_above_{n}")).alias(n) for n, c in windows(upper, "_block").items()],
    )


def carried_forward(
    rows: DataFrame, keys: list[str], order: str, values: dict[str, Column], width: int = BLOCK_WIDTH,
    upper_width: int | None = UPPER_WIDTH, size: int | None = None,
) -> DataFrame:
    """Add to every row the last value (not null) at or before it among the rows of its keys.

    `values` maps names of added columns to what a row gives. `order` is unique for a key. `size` is about how many rows there are,
    where that is known.
    """
    given = {n: f"_given_{i}" for i, n in enumerate(values)}
    rows = _in_blocks(rows.withColumns({given[n]: v for n, v in values.items()}), keys, order, width, size)
    blocks = rows.groupBy("_place").agg(
        *[F.max_by(g, F.when(F.col(g).isNotNull(), F.col(order))).alias(f"_last{g}") for g in given.values()]
    )
    borders = _borders(blocks, keys, [f"_last{g}" for g in given.values()], upper_width=upper_width)
    inside = Window.partitionBy("_place").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # Windows first: the join takes their order.
    rows = rows.withColumns({f"_own{g}": F.last(g, True).over(inside) for g in given.values()})
    added = {n: F.coalesce(f"_own{g}", f"_last{g}") for n, g in given.items()}
    return (
        rows.join(borders, F.col("_place") == F.col("_of_place"))
        .withColumns(added)
        .drop("_place", "_of_place", *given.values(), *[f"{p}{g}" for g in given.values() for p in ("_last", "_own")])
    )


def nearest_markers(
    rows: DataFrame,
    markers: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    before: str | None = None,
    after: str | None = None,
    width: int = BLOCK_WIDTH,
    upper_width: int | None = UPPER_WIDTH,
    size: int | None = None,
) -> DataFrame:
    """Give every row the value of the closest marker before and/or after it.

    Rows and markers that share `keys` are ordered by `order`, unique among the markers. A marker
    at a row's own place is neither before nor after it, so markers may be among the rows. `value`
    is what a marker carries (not null). `before` and `after` name the added columns, null
    where there is no such marker. `size` is about how many rows and markers there are, where that is known.
    """
    rows = rows.withColumn("_is_row", F.lit(True))
    markers = markers.select(*keys, order, value.alias("_mark"))
    # Blocks are counted and rows placed from the same shuffle, which Spark makes once.
    together = _in_blocks(rows.unionByName(markers, allowMissingColumns=True), keys, order, width, size)

    # One row per block, with the first and last marker in it, carried over the block borders.
    place_of_mark = F.when(F.col("_mark").isNotNull(), F.col(order))
    edges = {}
    if before:
        edges["_last"] = F.max_by("_mark", place_of_mark)
    if after:
        edges["_first"] = F.min_by("_mark", place_of_mark)
    blocks = together.groupBy("_place").agg(*[e.alias(n) for n, e in edges.items()])
    carried = _borders(blocks, keys, ["_last"] if before else [], ["_first"] if after else [], upper_width)

    # At one place the row comes first in either direction. Windows first: the join takes their order.
    inside, is_marker = Window.partitionBy("_place"), F.col("_is_row").isNull()
    own, added = {}, {}
    if before:
        up = inside.orderBy(order, is_marker).rowsBetween(Window.unboundedPreceding, -1)
        own["_before"] = F.last("_mark", True).over(up)
        added[before] = F.coalesce("_before", "_last")
    if after:
        down = inside.orderBy(F.desc(order), is_marker).rowsBetween(Window.unboundedPreceding, -1)
        own["_after"] = F.last("_mark", True).over(down)
        added[after] = F.coalesce("_after", "_first")
    return (
        together.withColumns(own)
        .filter(F.col("_is_row"))
        .join(carried, F.col("_place") == F.col("_of_place"))
        .withColumns(added)
        .drop("_place", "_of_place", "_is_row", "_mark", *own, *edges)
    )


def row_numbers(
    df: DataFrame, keys: list[str], order: str, name: str, width: int = BLOCK_WIDTH
) -> DataFrame:
    """Number the rows of each key from 1 in the order of a unique integer column.

    Blocks of blocks are made only where the order values spread that far, which is asked first. A null key is a key.
    """
    ends = df.agg(F.min(order).alias("first"), F.max(order).alias("last")).first()
    wide = ends.first is not None and ends.last // width - ends.first // width >= UPPER_WIDTH
    rows = df.withColumn("_place", F.struct(_block(order, width).alias("_block"), *keys))
    blocks = rows.groupBy("_place").agg(F.count(F.lit(1)).alias("_rows")).select("_place.*", "_rows")

    def before(n: str, over: list[str], by: str) -> Column:
        earlier = Window.partitionBy(over).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(earlier), F.lit(0))

    if wide:
        upper = keys + ["_upper"]
        blocks = blocks.withColumn("_upper", _block("_block", UPPER_WIDTH))
        uppers = blocks.groupBy(upper).agg(F.sum("_rows").alias("_rows"))
        uppers = uppers.select(*[F.col(c).alias(f"_up_{c}") for c in upper], before("_rows", keys, "_upper").alias("_above"))
        starts = blocks.withColumn("_start", before("_rows", upper, "_block")).join(uppers, _same(upper, "_up_"))
        starts = starts.withColumn("_start", F.col("_start") + F.col("_above"))
    else:
        starts = blocks.withColumn("_start", before("_rows", keys, "_block"))
    starts = starts.select(F.struct("_block", *keys).alias("_of_place"), "_start")
    inside = Window.partitionBy("_place").orderBy(order)
    # The join needs the same partitioning and sort prefix as the window before it.
    return (
        rows.withColumn("_number", F.row_number().over(inside))
        .join(starts, F.col("_place") == F.col("_of_place"))
        .withColumn(name, F.col("_start") + F.col("_number"))
        .drop("_place", "_of_place", "_start", "_number")
    )
