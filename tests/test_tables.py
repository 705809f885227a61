"""Reading tables over JDBC, as far as it goes without a database: what is asked of the reader."""

import datetime as dt

from pyspark.sql.readwriter import DataFrameReader

from changelake.functions.types import Field
from changelake.plans.config import Destination
from changelake.plans.full_load import full_load
from changelake.plans.progress_store import ProgressStore
from changelake.sources.tables import JdbcTables, fields_by_table

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def answers(spark, asked):
    """What a database with one table of 1200 pages would answer."""

    def jdbc(self, url, table, predicates=None, properties=None, **_):
        asked.append((url, table, predicates, properties))
        if "information_schema.columns" in table:
            return spark.createDataFrame(
                [
                    ("public", "t", "id", "bigint", "int8", "NO", 1),
                    ("public", "t", "at", "time without time zone", "time", "YES", 2),
                    ("public", "t", "tags", "ARRAY", "_int4", "YES", 3),
                    ("public", "pg_x", "id", "bigint", "int8", "NO", 1),
                    ("other", "t", "id", "bigint", "int8", "NO", 1),
                ],
                "table_schema string, table_name string, column_name string, data_type string, "
                "udt_name string, is_nullable string, ordinal_position int",
            )
        if "table_constraints" in table:
            return spark.createDataFrame(
                [("k", "public", "t", "PRIMARY KEY")],
                "constraint_name string, table_schema string, table_name string, "
                "constraint_type string",
            )
        if "key_column_usage" in table:
            return spark.createDataFrame(
                [("k", "public", "id")],
                "constraint_name string, table_schema string, column_name string",
            )
        if "pg_tables" in table:
            return spark.createDataFrame(
                [("public", "t", 8192, 1200 * 8192 - 5), ("other", "t", 8192, 9)],
                "schemaname string, tablename string, page bigint, bytes bigint",
            )
        n = len(predicates)
        return spark.createDataFrame(
            [(i, f"10:00:{i:02d}", [i]) for i in range(n)], "id int, at string, tags array<int>"
        )

    return jdbc


def test_load_over_jdbc(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(DataFrameReader, "jdbc", answers(spark, asked))
    source = JdbcTables("jdbc:postgresql://h:5432/d", {"user": "u"}, pages_per_chunk=500)
    fields = fields_by_table(source.discover(spark))
    assert fields == {
        "public.t": [
            Field("id", "INT64", False, True), Field("at", "TIME"), Field("tags", "ARRAY"),
        ]
    }
    destination = Destination(base_path=str(tmp_path / "out"))
    store = ProgressStore(str(tmp_path / "state"))
    read = full_load(
        spark, source, "public.t", fields["public.t"], destination, "t", store, NOW, 2
    )
    assert read == 3
    loads = [a for a in asked if a[1] == "public.t"]
    assert [a[2] for a in loads] == [
        ["ctid >= '(0,0)'::tid AND ctid < '(500,0)'::tid",
         "ctid >= '(500,0)'::tid AND ctid < '(1000,0)'::tid"],
        ["ctid >= '(1000,0)'::tid"],
    ]
    assert loads[0][3] == {
        "fetchsize": "5000", "preferTimestampNTZ": "true", "customSchema": "`at` STRING",
        "user": "u",
    }
    rows = destination.read(spark, "t").select("id", "at", "tags", "_cdc_operation").collect()
    assert sorted(tuple(r) for r in rows) == [
        (0, 36000000000, ["0"], "SNAPSHOT"),
        (0, 36000000000, ["0"], "SNAPSHOT"),
        (1, 36001000000, ["1"], "SNAPSHOT"),
    ]
