"""What several operators share: tables, kept intermediate results, and bindings inside expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word is a run of anything but the six ASCII white-space characters; `bytes.split()` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the folder that all executors share.

    It cuts the lineage: what follows survives lost executors without doing the work again.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value worked out once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def sampled(rows: DataFrame, label: str, per_class: int, key: Column) -> DataFrame:
    """About `per_class` rows of every class, the same at every run: those whose hash is below the class's share.

    The counts cover all rows; equal rows share a hash and stay once. Null labels are left out.
    """
    rows = rows.where(F.col(label).isNotNull())
    # One row per class; written, so that Spark knows how small it is and needn't deal rows out by class.
    counts = saved(rows.groupBy(F.col(label).alias("_class")).agg(F.count("*").alias("_n")), "classes")
    share = F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("_n"))
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(17), key))
    unit = F.shiftrightunsigned("_h", 11).cast("double") / float(1 << 53)
    kept = hashed.join(counts, F.col(label) == F.col("_class")).where(unit < share)
    return kept.drop("_class", "_n").dropDuplicates(["_h", label]).drop("_h")
