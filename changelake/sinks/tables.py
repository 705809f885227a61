"""Catalog tables of any format the session has a source for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _fitted(df: DataFrame, table: str, apart: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the table in its order. New columns of `df` are added to the table; those that it lacks are null."""
    spark = df.sparkSession
    there = {f.name: f.dataType for f in spark.table(table).schema.fields if f.name not in apart}
    new = [f for f in df.schema.fields if f.name not in there]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD COLUMNS ({columns})")
        there |= {f.name: f.dataType for f in new}
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in there.items()])


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append to `namespace.table`, which is created if absent, in one commit."""
    spark = df.sparkSession
    namespace = table.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}")
    if spark.catalog.tableExists(table):
        df = _fitted(df, table)
    df.write.format(fmt).mode("append").saveAsTable(table)


def replace_batch(df: DataFrame, table: str, batch_id: str, fmt: str = "parquet") -> None:
    """Write one batch as a partition of its own; the same batch again replaces it."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        namespace = table.rpartition(".")[0]
        if namespace:
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}")
        empty = df.limit(0).withColumn("batch_id", F.lit(batch_id))
        empty.write.format(fmt).partitionBy("batch_id").saveAsTable(table)
    rows = _fitted(df, table, ("batch_id",))
    names = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(
        f"INSERT OVERWRITE {_quoted(table)} PARTITION (batch_id = '{batch_id}') ({names}) "
        "SELECT * FROM {rows}",
        rows=rows,
    )
