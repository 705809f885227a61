"""Canonical column types and the Spark types that carry them."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical type -> Spark type. TIME is kept as microseconds of the day.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "TIME": T.LongType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP_TZ": T.TimestampType(),
    "DECIMAL": T.DecimalType(38, 18),
    "JSON": T.StringType(),
    "UUID": T.StringType(),
    "ARRAY": T.ArrayType(T.StringType()),
}

# Database type names of each canonical type.
TYPE_NAMES = {
    "INT32": ["smallint", "int2", "integer", "int4", "serial"],
    "INT64": ["bigint", "int8", "bigserial"],
    "FLOAT": ["real", "float4"],
    "DOUBLE": ["double precision", "float8"],
    "BOOLEAN": ["boolean", "bool"],
    "STRING": ["text", "varchar", "character varying", "char", "character", "name"],
    "BYTES": ["bytea"],
    "DATE": ["date"],
    "TIME": ["time", "time without time zone", "time with time zone", "timetz"],
    "TIMESTAMP": ["timestamp", "timestamp without time zone"],
    "TIMESTAMP_TZ": ["timestamp with time zone", "timestamptz"],
    "DECIMAL": ["numeric", "decimal"],
    "JSON": ["json", "jsonb"],
    "UUID": ["uuid"],
}

# Names that hold a keyword below by accident and stay text.
PLAIN_TEXT_NAMES = ["interval", "point"]

# Keyword found anywhere in an otherwise unknown name, tried in this order.
NAME_KEYWORDS = [
    ("int", "INT64"),
    ("float", "DOUBLE"),
    ("double", "DOUBLE"),
    ("bool", "BOOLEAN"),
    ("timestamp", "TIMESTAMP"),
    ("date", "DATE"),
    ("time", "TIME"),
    ("numeric", "DECIMAL"),
    ("decimal", "DECIMAL"),
]

# Metadata columns of every destination row.
OPERATION_COLUMN = "_cdc_operation"
TIMESTAMP_COLUMN = "_cdc_timestamp"
METADATA_FIELDS = [(OPERATION_COLUMN, T.StringType()), (TIMESTAMP_COLUMN, T.TimestampType())]


class Field(NamedTuple):
    """One column of a captured table."""

    name: str
    type: str = "STRING"
    nullable: bool = True
    primary_key: bool = False


# Envelope columns of a topic message.
ENVELOPE_FIELDS = [
    Field("_kafka_topic", "STRING"),
    Field("_kafka_partition", "INT32"),
    Field("_kafka_offset", "INT64"),
    Field("_kafka_key", "STRING"),
    Field("_kafka_timestamp_ms", "INT64"),
    Field("_payload", "JSON"),
]


def spark_type(canonical: str) -> T.DataType:
    """Spark type of a canonical type; `DECIMAL(p,s)` keeps its own precision."""
    if canonical.startswith("DECIMAL("):
        precision, scale = canonical[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return SPARK_TYPES[canonical]


def resolve_type(name: Column) -> Column:
    """Canonical type of a database type name (null stays STRING)."""
    plain = F.regexp_replace(F.lower(name), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    resolved = F.when(plain.startswith("_") | plain.endswith("[]"), "ARRAY")
    resolved = resolved.when(plain.isin(PLAIN_TEXT_NAMES), "STRING")
    for canonical, names in TYPE_NAMES.items():
        resolved = resolved.when(plain.isin(names), canonical)
    for keyword, canonical in NAME_KEYWORDS:
        resolved = resolved.when(plain.contains(keyword), canonical)
    return resolved.otherwise("STRING")


def topic_fields(payload: Iterable[Field | None] = (), normalize: bool = False) -> list[Field]:
    """Envelope columns, and the declared payload columns when normalising is on."""
    declared = []
    for field in payload if normalize else ():
        if field is not None and field.name and field.name.strip():
            declared.append(field._replace(type=field.type or "STRING"))
    return ENVELOPE_FIELDS + declared


def payload_fields(fields: Iterable[Field]) -> list[Field]:
    """The fields that come out of the payload, not out of the envelope."""
    return [f for f in fields if f.name != "_payload" and not f.name.startswith("_kafka_")]


def table_schema(fields: Iterable[Field]) -> T.StructType:
    """Spark schema of a captured table; type and key are kept as metadata."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                spark_type(f.type),
                f.nullable,
                {"cdc_type": f.type, "primary_key": f.primary_key},
            )
            for f in fields
        ]
    )


def destination_schema(fields: Iterable[Field]) -> T.StructType:
    """Schema of a destination table: the captured columns and two metadata columns."""
    extra = [T.StructField(name, kind, True) for name, kind in METADATA_FIELDS]
    return T.StructType(table_schema(fields).fields + extra)
