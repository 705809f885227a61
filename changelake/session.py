"""Session settings and shared folders."""

from __future__ import annotations

import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def use_utc(spark: SparkSession) -> None:
    """Timestamps without a zone are read as UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="changelake-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see, below the cluster's `spark.checkpoint.dir`.

    A temporary folder of this machine is used only where Spark itself runs on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows the driver plans with, as a frame whose size Spark knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(columns, to_arrow_schema(schema)), schema)
