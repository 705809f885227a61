"""Dated Parquet folders."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.sinks import folders

# File settings used where a destination names none.
FILE_SIZE_MB = 256
ROW_GROUP_SIZE_MB = 128
COMPRESSION = "SNAPPY"

# Bytes one value is taken to need in a file: a guess for a table's first batch.
_WIDTHS = {"integer": 4, "long": 8, "float": 4, "double": 8, "boolean": 1, "date": 4}
_TEXT_WIDTH = 24


def records_per_file(schema: T.StructType, file_size_mb: int = FILE_SIZE_MB) -> int:
    """How many rows make a file of about the wanted size."""
    width = sum(_WIDTHS.get(f.dataType.typeName(), _TEXT_WIDTH) for f in schema.fields)
    return max(file_size_mb * 1024 * 1024 // max(width, 1), 1)


# A table's sizes are noted in names of empty files, `<batch>~<rows>~<bytes>`; readers pass over the folder.
SIZES = "_sizes"
# Batches that say how wide a row is, and the fewest rows they need together.
MEASURED_BATCHES, LEAST_ROWS = 8, 1000


def measured_width(spark: SparkSession, at: str) -> float | None:
    """Bytes a row took in the files of a table's last batches; None before enough rows were written."""
    rows = size = 0
    for name in reversed(folders.names(spark, f"{at}/{SIZES}")[-MEASURED_BATCHES:]):
        _, n, b = name.rsplit("~", 2)
        rows, size = rows + int(n), size + int(b)
    return size / rows if rows >= LEAST_ROWS else None


def _note_size(spark: SparkSession, at: str, batch_id: str, rows: int, size: int) -> None:
    if not rows:
        return
    known = folders.names(spark, f"{at}/{SIZES}")
    for name in [n for n in known if n.startswith(f"{batch_id}~")] + known[: -4 * MEASURED_BATCHES]:
        folders.remove(spark, f"{at}/{SIZES}/{name}")
    folders.touch(spark, f"{at}/{SIZES}/{batch_id}~{rows}~{size}")


def append_parquet(
    df: DataFrame,
    base_path: str,
    table: str,
    ingest_date: datetime.date,
    compression: str = COMPRESSION,
    row_group_size_mb: int = ROW_GROUP_SIZE_MB,
    file_size_mb: int = FILE_SIZE_MB,
    max_records: int | None = None,
) -> None:
    """Append files of bounded size as a batch that is never repeated."""
    write_batch(
        df, base_path, table, f"append-{uuid.uuid4().hex}", ingest_date, compression,
        row_group_size_mb, file_size_mb, max_records,
    )


def write_batch(
    df: DataFrame,
    base_path: str,
    table: str,
    batch_id: str,
    ingest_date: datetime.date,
    compression: str = COMPRESSION,
    row_group_size_mb: int = ROW_GROUP_SIZE_MB,
    file_size_mb: int = FILE_SIZE_MB,
    max_records: int | None = None,
) -> None:
    """Write one batch to a folder of its own, `table/ingest_date=.../batch_id=...`; the same batch again replaces it.

    A batch that is repeated on a later day keeps the day of its first attempt, so it replaces
    itself and a read of one day lists the batches of that day only.

    Files are cut by rows. How many make the wanted size is taken from the bytes a row took in the table's last batches.
    """
    spark, day = df.sparkSession, f"ingest_date={ingest_date.isoformat()}"
    at = f"{base_path}/{table}"
    before = folders.matching(spark, f"{at}/ingest_date=*/batch_id={batch_id}")
    width = None if max_records else measured_width(spark, at)
    of_width = max(int(file_size_mb * 1024 * 1024 / width), 1) if width else records_per_file(df.schema, file_size_mb)
    folder = f"{at}/{min(before, default=day)}/batch_id={batch_id}"
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.option("compression", compression.lower())
        .option("parquet.block.size", row_group_size_mb * 1024 * 1024)
        .option("maxRecordsPerFile", max_records or of_width)
        .mode("overwrite")
        .parquet(folder)
    )
    _note_size(spark, at, batch_id, written.get.get("rows") or 0, folders.bytes_below(spark, folder))
