"""Table sources for snapshots: a database over JDBC, or tables landed as Parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.types import SPARK_TYPES, Field
from changelake.operators.catalog import discover
from changelake.session import small_frame
from changelake.sinks import folders
from changelake.sources.snapshot import (
    FETCH_SIZE,
    PAGES_PER_FILE,
    ctid_predicates,
    page_chunks,
)

DISCOVERED = (
    "table_name string, column_name string, type string, nullable boolean, "
    "primary_key boolean, ordinal_position int"
)


class Ranges(NamedTuple):
    """The ranges of a table: how many there are, and how to read those from first to last."""

    count: int
    read: Callable[[int, int], DataFrame]


def fields_by_table(discovered: DataFrame) -> dict[str, list[Field]]:
    """Discovered columns as fields of each table, for planning."""
    out: dict[str, list[Field]] = {}
    for r in discovered.orderBy("table_name", "ordinal_position").collect():
        field_ = Field(r.column_name, r.type, r.nullable, r.primary_key)
        out.setdefault(r.table_name, []).append(field_)
    return out


def canonical_type(kind: T.DataType) -> str:
    """Canonical type that holds every value of a Spark type; nested types have none and are refused."""
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return "INT32"
    if isinstance(kind, T.DecimalType):
        return "DECIMAL" if kind == SPARK_TYPES["DECIMAL"] else f"DECIMAL({kind.precision},{kind.scale})"
    if isinstance(kind, (T.StructType, T.MapType)):
        raise ValueError(f"columns of type {kind.simpleString()} can't be captured")
    return next((c for c, t in SPARK_TYPES.items() if t == kind), "STRING")


LISTED = "n bigint, path string, size bigint"


@dataclass(frozen=True)
class FileTables:
    """Tables landed as Parquet. A range is a file, so each file is read once however it is sorted.

    `keys` names the primary key columns of each table that has some: one name or several.
    """

    paths: dict[str, str]
    keys: dict[str, str | tuple[str, ...]]

    def discover(self, spark: SparkSession) -> DataFrame:
        rows = []
        for table, path in self.paths.items():
            keys = self.keys.get(table, ())
            keys = (keys,) if isinstance(keys, str) else tuple(keys)
            for n, f in enumerate(spark.read.parquet(path).schema.fields, 1):
                is_key = f.name in keys
                rows.append((table, f.name, canonical_type(f.dataType), not is_key, is_key, n))
        return small_frame(spark, rows, DISCOVERED)

    def files(self, spark: SparkSession, table: str) -> DataFrame:
        """The files of a table, numbered from the oldest on."""
        listed = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(self.paths[table])
            .select("modificationTime", "path", F.col("length").alias("size"))
        )
        order = Window.orderBy("modificationTime", "path")
        return listed.select((F.row_number().over(order) - 1).cast("bigint").alias("n"), "path", "size")

    def ranges(
        self, spark: SparkSession, table: str, fields: list[Field], count: int | None = None, listing: str | None = None
    ) -> Ranges:
        """A range for each file. The files are listed once, in the folder `listing`, and ranges refer to that list.

        So a load that is resumed reads the files it began with, each once, whatever came or went meanwhile: a file that is gone or has another
        size raises, files that came later belong to the last range.
        """
        if listing is None or not folders.exists(spark, f"{listing}/_SUCCESS"):
            files = self.files(spark, table)
            if listing is not None:
                files.write.mode("overwrite").parquet(listing)
        if listing is not None:
            files = spark.read.schema(LISTED).parquet(listing)
        count = max(files.count(), 1)
        names = [f.name for f in fields]
        path = self.paths[table]
        reader = spark.read.schema(spark.read.parquet(path).schema)
        if folders.is_folder(spark, path):
            reader = reader.option("basePath", path)

        def read(first: int, last: int) -> DataFrame:
            # The paths of one wave of ranges, which is what is read at once.
            wave = files.filter(F.col("n").between(first, last)).orderBy("n").collect()
            for r in wave:
                if folders.size(spark, r.path) != r.size:
                    raise FileNotFoundError(f"{r.path} is gone or has changed since the load of {table} began")
            part = [r.path for r in wave]
            if last == count - 1 and listing is not None:
                later = self.files(spark, table).join(files.select("path"), "path", "left_anti")
                part += [r.path for r in later.orderBy("n").collect()]
            rows = reader.parquet(*part) if part else reader.parquet(path).limit(0)
            return rows.select(names)

        return Ranges(count, read)


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a PostgreSQL database, split by ranges of physical pages.

    Needs the database's JDBC driver on the class path.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    schemas: tuple[str, ...] = ("public",)
    pages_per_chunk: int = PAGES_PER_FILE

    def _query(self, spark: SparkSession, sql: str) -> DataFrame:
        return spark.read.jdbc(self.url, f"({sql}) q", properties=self.properties)

    def discover(self, spark: SparkSession) -> DataFrame:
        names = [
            ("columns", "table_schema, table_name, column_name, data_type, udt_name, "
                        "is_nullable, ordinal_position"),
            ("table_constraints", "constraint_name, table_schema, table_name, constraint_type"),
            ("key_column_usage", "constraint_name, table_schema, column_name"),
        ]
        views = [
            self._query(spark, f"SELECT {cols} FROM information_schema.{v}") for v, cols in names
        ]
        return discover(*views, schemas=self.schemas)

    def ranges(
        self, spark: SparkSession, table: str, fields: list[Field], count: int | None = None, listing: str | None = None
    ) -> Ranges:
        schema, _, name = table.partition(".")
        # What the files of each table hold now, whatever the statistics say; a partitioned parent has its parts' sizes.
        sizes = self._query(
            spark,
            "SELECT schemaname, tablename, pg_size_bytes(current_setting('block_size')) AS page, "
            "(SELECT coalesce(sum(pg_relation_size(t.relid)), 0) FROM "
            "pg_partition_tree(format('%I.%I', schemaname, tablename)::regclass) t) AS bytes FROM pg_tables",
        ).filter((F.col("schemaname") == schema) & (F.col("tablename") == name))
        row = sizes.select(F.ceil(F.col("bytes") / F.col("page")).cast("bigint")).first()
        chunks = page_chunks("ctid", row[0] if row else 0, self.pages_per_chunk)
        chunks = chunks._replace(count=count or chunks.count)

        # Times of day are read as text; timestamps without a zone stay without one.
        as_text = ", ".join(f"`{f.name}` STRING" for f in fields if f.type == "TIME")
        properties = {"fetchsize": str(FETCH_SIZE), "preferTimestampNTZ": "true"}
        if as_text:
            properties["customSchema"] = as_text
        properties |= self.properties

        def read(first: int, last: int) -> DataFrame:
            predicates = ctid_predicates(chunks, first, last)
            rows = spark.read.jdbc(self.url, table, predicates=predicates, properties=properties)
            return rows.select([f.name for f in fields])

        return Ranges(chunks.count, read)
