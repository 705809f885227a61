"""Transactions of a change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.functions.positions import format_lsn, parse_lsn
from changelake.operators.changes import is_change
from changelake.operators.ordered import BLOCK_WIDTH, nearest_markers


def assemble_transactions(
    log: DataFrame, changes: DataFrame | None = None, width: int = BLOCK_WIDTH, size: int | None = None
) -> DataFrame:
    """Row changes of committed transactions, with the transaction they belong to.

    A change is committed when the closest BEGIN or COMMIT before it is a BEGIN and the closest
    one after it is a COMMIT. The others are held back: their COMMIT has not been seen, or the
    transaction was started over. Adds `tx_xid`, `commit_seq` and `commit_lsn`.

    `changes` may hold the row changes of the log already resolved and filtered, so that only
    those are shuffled; otherwise they are taken from the log. `size` is the number of messages, counted if it is not given.
    """
    if changes is None:
        changes = log.filter(is_change())
    control = log.filter(F.col("msg_type").isin("B", "C"))
    placed = nearest_markers(
        changes,
        control.select("stream_id", "seq", "lsn", "msg_type", "xid"),
        ["stream_id"],
        "seq",
        value=F.struct("msg_type", "xid", "seq", "lsn"),
        before="_begin",
        after="_commit",
        width=width,
        size=log.count() if size is None else size,
    )
    return placed.filter(
        (F.col("_begin.msg_type") == "B") & (F.col("_commit.msg_type") == "C")
    ).select(
        *changes.columns,
        F.col("_begin.xid").alias("tx_xid"),
        F.col("_commit.seq").alias("commit_seq"),
        F.col("_commit.lsn").alias("commit_lsn"),
    )


def last_commits(log: DataFrame) -> DataFrame:
    """The last COMMIT of each stream: `commit_seq` and its position."""
    return (
        log.filter(F.col("msg_type") == "C")
        .groupBy("stream_id")
        .agg(
            F.max("seq").alias("commit_seq"),
            F.max(parse_lsn(F.col("lsn"))).alias("last_position"),
        )
    )


def commit_positions(log: DataFrame, targets: DataFrame) -> DataFrame:
    """The last commit position, set on every target table and as the global position."""
    last = log.filter(F.col("msg_type") == "C").agg(F.max(parse_lsn(F.col("lsn"))))
    return targets.select(
        "table_name", last.scalar().alias("last_position"), F.lit("cdc").alias("sync_mode")
    ).withColumn("last_lsn", format_lsn(F.col("last_position")))


def stream_positions(log: DataFrame, targets: DataFrame) -> DataFrame:
    """For every target table (stream_id, table_name) the last commit of its own stream.

    Positions of different streams can't be compared, so there is one for each stream and none over all. A table of two streams has
    a row for each; a stream without a commit has no position yet.
    """
    last = last_commits(log).select("stream_id", "commit_seq", "last_position")
    known = targets.select("stream_id", "table_name").distinct().join(last, "stream_id", "left")
    return known.withColumns({"sync_mode": F.lit("cdc"), "last_lsn": F.when(F.col("last_position").isNotNull(), format_lsn(F.col("last_position")))})
