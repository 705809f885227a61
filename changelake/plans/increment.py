"""Reading a table again and again, each time what is new by its cursor column.

    <store>/g=<n>/cursor/<table>/v=<version>/{mark,ids}   and `_COMMITTED`, written last
"""

from __future__ import annotations

import datetime
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions.types import OPERATION_COLUMN
from changelake.operators.increment import Mark, cursor_increment, passed_over
from changelake.operators.records import add_cdc_metadata
from changelake.plans.config import Destination
from changelake.plans.progress_store import ProgressStore
from changelake.sinks import folders

KEPT_VERSIONS = 2

log = logging.getLogger(__name__)


def read_increment(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    cursor: str,
    ids: list[str],
    destination: Destination,
    destination_table: str,
    store: ProgressStore,
    ingest_ts: datetime.datetime,
) -> tuple[int, int]:
    """Append the rows that are new since the last run; returns how many, and how many came late.

    The highest value is fixed first, so rows that arrive meanwhile are left to the next run. The rows are written before the mark is, under the number of the
    run: a run that is repeated replaces its own rows and none is lost or doubled, also among rows of equal values. Late rows, which have lower values than
    the mark, are counted and logged. An empty table changes nothing.
    """
    generation = store.generation(spark)
    root = f"{store.folder(spark)}/cursor/{table}"
    versions = [v for v in folders.numbered(spark, root, "v=") if folders.exists(spark, f"{root}/v={v}/_COMMITTED")]
    version = versions[-1] + 1 if versions else 0
    mark, seen = None, None
    if versions:
        saved = spark.read.parquet(f"{root}/v={versions[-1]}/mark").first()
        mark, seen = Mark(saved.value, saved.below), spark.read.parquet(f"{root}/v={versions[-1]}/ids")
    over = passed_over(rows, cursor, mark).first()
    if over.late or over.no_cursor:
        log.warning("%s: %s rows came late, %s have no %s", table, over.late, over.no_cursor, cursor)
    high = rows.agg(F.max(cursor)).first()[0]
    if high is None:
        return 0, over.late
    batch_id = f"increment-{generation}-{version:010d}"
    new = cursor_increment(rows, cursor, ids, mark, seen, high).withColumn("_cdc_position", F.lit(0).cast("bigint"))
    destination.write_batch(add_cdc_metadata(new, F.lit("SNAPSHOT"), F.lit(ingest_ts)), destination_table, batch_id, ingest_ts.date())
    # What was written is what the mark stands for.
    written = destination.read(spark, destination_table).filter((F.col("batch_id") == batch_id) & (F.col(OPERATION_COLUMN) == "SNAPSHOT"))
    counts = written.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(cursor) < F.lit(high), 1)).alias("below")).first()
    tied = written.filter(F.col(cursor) == F.lit(high)).select(*ids)
    below = counts.below + (mark.below if mark else 0)
    if mark is not None and mark.value == high:
        tied = tied.unionByName(seen)
    elif mark is not None:
        below += seen.count()
    at = f"{root}/v={version}"
    tied.write.mode("overwrite").parquet(f"{at}/ids")
    value = spark.range(1).select(F.lit(high).cast(rows.schema[cursor].dataType).alias("value"), F.lit(below).cast("bigint").alias("below"))
    value.write.mode("overwrite").parquet(f"{at}/mark")
    folders.touch(spark, f"{at}/_COMMITTED")
    for old in versions[: -KEPT_VERSIONS + 1]:
        folders.remove(spark, f"{root}/v={old}")
    return counts.n, over.late
