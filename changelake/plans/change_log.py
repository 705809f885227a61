"""Change messages to typed change logs of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changelake.functions.types import OPERATION_COLUMN, TIMESTAMP_COLUMN, Field
from changelake.operators.changes import image_columns, image_texts, is_change, resolve_relation, target_filter
from changelake.operators.ordered import BLOCK_WIDTH
from changelake.operators.records import add_cdc_metadata, change_operation, count_malformed, enforce_required
from changelake.operators.transactions import assemble_transactions


def committed_changes(
    log: DataFrame,
    targets: DataFrame | list[str],
    ingest_ts: Column,
    earlier: DataFrame | None = None,
    width: int = BLOCK_WIDTH,
    truncates: bool = False,
) -> DataFrame:
    """Committed row changes of the target tables, with table name, operation and time.

    With `truncates`, the committed TRUNCATEs of these tables are among them.

    Naming the tables and dropping what is not wanted needs no shuffle, so it comes before the
    transactions, which need one.
    """
    size = log.count()
    wanted = target_filter(resolve_relation(log, earlier, width, truncates, size=size), targets)
    committed = assemble_transactions(log, wanted, width, size)
    return add_cdc_metadata(committed, change_operation(), ingest_ts)


def table_changes(changes: DataFrame, table: str, fields: list[Field], seen: Observation | None = None) -> DataFrame:
    """The change log of one table: its typed columns, metadata, and the reject reason.

    The image of a DELETE may hold the key only, so required columns are not asked of it. `seen` gets the counts of malformed values.
    """
    own = changes.filter((F.col("table_name") == table) & is_change())
    texts = image_texts(fields) if seen is not None else {}
    rows = own.select(
        *image_columns(fields),
        F.col("seq").alias("_cdc_position"),
        OPERATION_COLUMN,
        TIMESTAMP_COLUMN,
        *[c.alias(f"_text_{n}") for n, c in texts.items()],
    )
    if seen is not None:
        named = {n: F.col(f"`_text_{n}`") for n in texts}
        rows = count_malformed(rows, named, fields, seen).drop(*[f"_text_{n}" for n in texts])
    keep = F.when(F.col(OPERATION_COLUMN) != "DELETE", F.col("_reject_reason"))
    return enforce_required(rows, fields).withColumn("_reject_reason", keep)
