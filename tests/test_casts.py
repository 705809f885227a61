import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changelake.functions.casts import cast_columns, cast_text, conform
from changelake.functions.payload import parse_payload, typed_fields
from changelake.functions.positions import format_lsn, parse_lsn
from changelake.functions.types import Field

D = Decimal
CASES = {
    "INT32": [("12", 12), ("-3.9", -3), ("1e3", 1000), ("2147483648", None), ("x", None),
              ("", None), (None, None)],
    "INT64": [("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("3.7", 3),
              ("12abc", None)],
    "DOUBLE": [("1.5", 1.5), ("1e300", 1e300), ("NaN?", None), ("-0.25", -0.25)],
    "FLOAT": [("1.5", 1.5), ("abc", None)],
    "DECIMAL": [("1.25", D("1.250000000000000000")), ("x", None),
                ("12345678901234567890.5", D("12345678901234567890.500000000000000000")),
                ("123456789012345678901", None)],
    "BOOLEAN": [("t", True), ("TRUE", True), ("f", False), ("yes", False), (None, None)],
    "STRING": [("", ""), (" a ", " a "), (None, None)],
    "JSON": [('{"a": 1}', '{"a": 1}')],
    "UUID": [("0-0", "0-0")],
    "BYTES": [("\\x6162", b"ab"), ("plain", b"plain"), ("\\x6", b"\x06"), ("\\xzz", None),
              ("\\x", b""), (None, None)],
    "DATE": [("2024-02-29", dt.date(2024, 2, 29)), ("2023-02-29", None), ("x", None)],
    "TIME": [("00:00:00", 0), ("23:59:59.999999", 86399999999), ("10:20", 37200000000),
             ("10:20:30+02", 30030000000), ("24:00:01", None), ("x", None), (None, None)],
    "TIMESTAMP": [("2024-01-01 10:20:30.123456", dt.datetime(2024, 1, 1, 10, 20, 30, 123456)),
                  ("2024-01-01T10:20:30", dt.datetime(2024, 1, 1, 10, 20, 30)),
                  ("2024-01-32 00:00:00", None)],
    "ARRAY": [('["a","b"]', ["a", "b"]), ("{a,b}", ["a", "b"]), ("{}", []),
              ('{"a,1","q\\"q",NULL,"NULL"}', ["a,1", 'q"q', None, "NULL"]),
              ("{1, 2}", ["1", "2"]), ("{{a},{b}}", None), ("{a,,b}", None), ("plain", None),
              (None, None)],
}


@pytest.mark.parametrize("canonical", list(CASES))
def test_cast_text(spark, canonical):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES[canonical])], "i int, x string")
    typed = rows.select("i", cast_text(F.col("x"), canonical).alias("y")).orderBy("i").collect()
    got = [bytes(r.y) if isinstance(r.y, bytearray) else r.y for r in typed]
    assert got == [c[1] for c in CASES[canonical]]


def test_timestamp_tz(spark):
    texts = ["2024-01-01T10:00:00Z", "2024-01-01 10:00:00+00", "2024-01-01 12:00:00+02:00",
             "2024-01-01 10:00:00", "2024-01-01T10:00:00.000001Z", "no"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = rows.select("i", F.unix_micros(cast_text(F.col("x"), "TIMESTAMP_TZ")).alias("us"))
    base = 1704103200000000
    assert [r.us for r in got.orderBy("i").collect()] == [base, base, base, base, base + 1, None]


PAYLOADS = [
    ('{"k": 1, "s": "a"}', 1, "a"),
    ('{"k": "12", "s": 5}', 12, "5"),
    ('{"k": 3.7, "s": true}', 3, "true"),
    ('{"k": 1, "k": 2}', 2, None),
    ('{"k": null, "s": null}', None, None),
    ('{"k": [1], "s": {"a":1}}', None, '{"a":1}'),
    ('{"k": "x", "s": "kept"}', None, "kept"),
    ('{"K": 1}', None, None),
    ("[1]", None, None),
    ("5", None, None),
    ("null", None, None),
    ("not json", None, None),
    ('{"k": 1, ', None, None),
    ("", None, None),
    ("   ", None, None),
    (None, None, None),
]


def test_payload(spark):
    fields = [Field("k", "INT64"), Field("s", "STRING")]
    rows = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PAYLOADS)], "i int, p string")
    parsed = rows.withColumn("j", parse_payload(F.col("p"), fields))
    got = parsed.select("i", *typed_fields(F.col("j"), fields)).orderBy("i").collect()
    assert [(r.k, r.s) for r in got] == [p[1:] for p in PAYLOADS]


def test_cast_columns_keeps_the_rest(spark):
    df = spark.createDataFrame([("1", "x", 5)], "a string, `b.c` string, d int")
    out = cast_columns(df, [Field("a", "INT32")])
    assert out.dtypes == [("a", "int"), ("b.c", "string"), ("d", "int")]


def test_conform_leaves_typed_columns_alone(spark):
    df = spark.createDataFrame([(1, "7", 2.5)], "a bigint, b string, c double")
    out = conform(df, [Field("a", "INT64"), Field("b", "INT32"), Field("c", "DECIMAL")])
    assert out.dtypes == [("a", "bigint"), ("b", "int"), ("c", "decimal(38,18)")]
    assert out.first() == (1, 7, D("2.500000000000000000"))


def test_lsn(spark):
    cases = [("16/B374D848", 97500059720), ("0/0", 0), ("FFFFFFFF/0", None), ("x/1", None),
             ("1", None), ("1/2/3", None), (None, None)]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, lsn string")
    got = rows.select("i", parse_lsn(F.col("lsn")).alias("p")).orderBy("i").collect()
    assert [r.p for r in got] == [c[1] for c in cases]
    text = spark.createDataFrame([(97500059720,)], "p bigint").select(format_lsn(F.col("p")))
    assert text.first()[0] == "16/B374D848"


def test_times_of_day(spark):
    hour = 3600 * 1_000_000
    texts = {
        "10:00:00": 10 * hour, "10:00:00+02": 8 * hour, "10:00:00.5-03:30": int(13.5 * hour) + 500_000, "01:00:00+02:00": 23 * hour, "24:00:00": 24 * hour,
        "23:59:59Z": 24 * hour - 1_000_000, "10:00": 10 * hour, "nonsense": None, "25:00:00": None, "": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cast_text(F.col("t"), "TIME").alias("m"))
    assert {r.t: r.m for r in df.collect()} == texts
