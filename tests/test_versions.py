"""Schema versions: spans, wider types, rows of all versions in one table."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from changelake.operators import versions as ver
from changelake.operators.changes import MESSAGE_SCHEMA

RELATION = "stream_id string, rel_oid long, seq long, rel_namespace string, rel_table string, rel_columns array<string>, rel_types array<string>"


def relation(seq, names, types, oid=1, stream="s", table="t"):
    return (stream, oid, seq, "shop", table, names, types)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, RELATION)


def change(seq, values, kind="I", oid=1, stream="s"):
    tuple_ = [("n", None) if v is None else ("t", v) for v in values]
    return (stream, seq, None, kind, None, oid, None, None, None, tuple_ if kind == "D" else None, None if kind == "D" else tuple_, None)


@pytest.mark.parametrize("types, want", [
    ([], None), (["INT32"], "INT32"), (["INT32", "INT64"], "INT64"), (["FLOAT", "INT32"], "DOUBLE"), (["DOUBLE", "INT64"], "STRING"),
    (["DECIMAL", "INT64"], "DECIMAL"), (["DATE", "TIMESTAMP"], "TIMESTAMP"), (["DATE", "INT32"], "STRING"), (["JSON", "STRING"], "STRING"), (["JSON"], "JSON"),
])
def test_wider_type(spark, types, want):
    df = spark.createDataFrame([(types,)], "types array<string>")
    assert df.select(ver.wider_type(F.col("types"))).first()[0] == want


def test_versions_are_spans(spark):
    """Repeats, messages delivered twice, no oid, null columns and types, two streams with equal oids."""
    a, b = (["id", "x"], ["int4", "text"]), (["id", "x"], ["int8", "text"])
    rows = [relation(1, *a), relation(1, *a), relation(5, *a), relation(9, *b), relation(12, *b), relation(20, *a)]
    rows += [relation(7, *b, oid=None), relation(3, None, None, oid=2), relation(4, ["y"], None, oid=2), relation(2, *b, stream="other")]
    random.Random(1).shuffle(rows)
    for width in (2, 65_536):
        got = ver.relation_versions(rows_of(spark, rows), width=width).orderBy("stream_id", "rel_oid", "version").collect()
        assert [(r.stream_id, r.rel_oid, r.version, r.seq_from, r.seq_to) for r in got] == [
            ("other", 1, 1, 2, None), ("s", 1, 1, 1, 9), ("s", 1, 2, 9, 20), ("s", 1, 3, 20, None), ("s", 2, 1, 3, 4), ("s", 2, 2, 4, None)
        ]
        assert got[5].columns[0] == ("y", "STRING") and got[4].columns == [] and got[2].columns[0].type == "INT64"
    assert ver.relation_versions(rows_of(spark, [])).collect() == []


def test_merged_columns(spark):
    rows = [relation(1, ["id", "a", "gone"], ["int4", "date", "bool"]), relation(9, ["new", "id", "a"], ["text", "int8", "timestamp"])]
    rows += [relation(4, ["only"], ["uuid"], oid=2, table="u")]
    got = ver.merged_columns(ver.relation_versions(rows_of(spark, rows))).orderBy("table_name", "place").collect()
    assert [(r.table_name, r.name, r.type, r.missing) for r in got] == [
        ("shop.t", "id", "INT64", False), ("shop.t", "a", "TIMESTAMP", False), ("shop.t", "gone", "BOOLEAN", True), ("shop.t", "new", "STRING", True),
        ("shop.u", "only", "UUID", False),
    ]
    assert got[0].types == ["INT32", "INT64"]


def test_rows_of_all_versions_in_one_table(spark, tmp_path):
    """ADD, DROP, widened and turned into text; a change before any version; values malformed for their own version."""
    relations = rows_of(spark, [
        relation(10, ["id", "n", "d", "gone"], ["int4", "int4", "date", "bool"]),
        relation(20, ["id", "n", "d", "new"], ["int8", "text", "timestamp", "float8"]),
    ])
    changes = spark.createDataFrame([
        change(5, ["0", "0", "2020-01-01", "t"]),
        change(11, ["1", "7", "2020-01-01", "t"]),
        change(12, ["99999999999", "007", "never", "f"]),
        change(20 + 1, ["99999999999", "seven", "2020-01-02 03:04:05", "1.5"]),
        change(22, ["3", None, None, None], "D"),
        change(23, ["4"]),
        change(24, ["5", "x", None, "2", "more"]),
        change(25, ["6"], oid=None),
    ], MESSAGE_SCHEMA)
    versions = ver.relation_versions(relations)
    columns = ver.merged_columns(versions).collect()
    assert [f.type for f in ver.fields_of(columns)] == ["INT64", "STRING", "TIMESTAMP", "BOOLEAN", "DOUBLE"]
    for width in (3, 65_536):
        df = ver.landed(ver.in_force(changes, versions, width=width), columns)
        df.write.mode("overwrite").parquet(f"{tmp_path}/t")
        got = {r.seq: tuple(r)[2:] for r in spark.read.parquet(f"{tmp_path}/t").collect()}
        day, time = datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2, 3, 4, 5)
        assert got == {
            11: ("I", 1, 1, "7", day, True, None),
            12: ("I", 1, None, "007", None, False, None),
            21: ("I", 2, 99999999999, "seven", time, None, 1.5),
            22: ("D", 2, 3, None, None, None, None),
            23: ("I", 2, 4, None, None, None, None),
            24: ("I", 2, 5, "x", None, None, 2.0),
        }
    assert spark.read.parquet(f"{tmp_path}/t").schema["id"].metadata["cdc_type"] == "INT64"


def test_no_rows(spark):
    versions = ver.relation_versions(rows_of(spark, []))
    assert ver.merged_columns(versions).collect() == []
    changes = spark.createDataFrame([change(1, ["1"])], MESSAGE_SCHEMA)
    assert ver.landed(ver.in_force(changes, versions), []).collect() == []
