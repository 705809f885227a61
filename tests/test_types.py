import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.types import (
    ENVELOPE_FIELDS,
    TYPE_NAMES,
    Field,
    destination_schema,
    payload_fields,
    resolve_type,
    table_schema,
    topic_fields,
)

EDGES = {
    None: "STRING",
    "": "STRING",
    " BIGINT\t": "INT64",
    "_int4": "ARRAY",
    "text[]": "ARRAY",
    "_": "ARRAY",
    "interval": "STRING",
    "point": "STRING",
    "int4range": "INT64",
    "tinyint": "INT64",
    "myfloat": "DOUBLE",
    "doubledate": "DOUBLE",
    "xbool": "BOOLEAN",
    "timestamp(3)": "TIMESTAMP",
    "daterange": "DATE",
    "timedelta": "TIME",
    "numeric(10,2)": "DECIMAL",
    "decimal(4)": "DECIMAL",
    "inet": "STRING",
    "USER-DEFINED": "STRING",
}


def test_resolve_type(spark):
    want = dict(EDGES)
    for canonical, names in TYPE_NAMES.items():
        want.update({n: canonical for n in names})
        want.update({f"  {n.upper()} ": canonical for n in names})
    rows = spark.createDataFrame([(n,) for n in want], "name string")
    got = {r.name: r.type for r in rows.select("name", resolve_type(F.col("name")).alias("type")).collect()}
    assert got == want
    assert sum(len(v) for v in TYPE_NAMES.values()) == 35


def test_topic_fields():
    payload = [Field("a", "INT64"), None, Field(" "), Field("b", None), Field("c", "DATE", False)]
    assert topic_fields(payload, normalize=False) == ENVELOPE_FIELDS
    assert topic_fields([], normalize=True) == ENVELOPE_FIELDS
    fields = topic_fields(payload, normalize=True)
    assert fields[6:] == [Field("a", "INT64"), Field("b", "STRING"), Field("c", "DATE", False)]
    assert payload_fields([*fields, Field("_kafka_x")]) == fields[6:]


def test_destination_schema():
    schema = destination_schema([Field("id", "INT64", False, True), Field("at", "TIMESTAMP")])
    assert [(f.name, f.dataType, f.nullable) for f in schema.fields] == [
        ("id", T.LongType(), False),
        ("at", T.TimestampNTZType(), True),
        ("_cdc_operation", T.StringType(), True),
        ("_cdc_timestamp", T.TimestampType(), True),
    ]
    assert schema["id"].metadata == {"cdc_type": "INT64", "primary_key": True}


@pytest.mark.parametrize(
    "canonical,kind",
    [
        ("DECIMAL", T.DecimalType(38, 18)),
        ("TIME", T.LongType()),
        ("ARRAY", T.ArrayType(T.StringType())),
        ("JSON", T.StringType()),
        ("UUID", T.StringType()),
        ("BYTES", T.BinaryType()),
    ],
)
def test_spark_types(canonical, kind):
    assert table_schema([Field("x", canonical)])["x"].dataType == kind
