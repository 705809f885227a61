import datetime as dt
import glob
import os
import uuid

import pytest

from changelake.plans.config import Destination
from changelake.sinks.parquet import append_parquet, measured_width, records_per_file, write_batch
from changelake.sinks.tables import append_table, replace_batch
from changelake.sinks.topics import publish_frame

DAY = dt.date(2024, 6, 1)
NEXT_DAY = dt.date(2024, 6, 2)


def numbers(spark, n, start=0):
    return spark.range(start, start + n).withColumnRenamed("id", "x")


def test_append_parquet(spark, tmp_path):
    base = str(tmp_path)
    append_parquet(numbers(spark, 10), base, "t", DAY)
    append_parquet(numbers(spark, 5, 10), base, "t", DAY)
    append_parquet(numbers(spark, 5, 15), base, "t", NEXT_DAY)
    rows = spark.read.parquet(f"{base}/t")
    assert sorted(r.x for r in rows.collect()) == list(range(20))
    assert rows.filter("ingest_date = '2024-06-01'").count() == 15
    assert glob.glob(f"{base}/t/ingest_date=2024-06-01/batch_id=*/*.snappy.parquet")


def test_bounded_files(spark, tmp_path):
    base = str(tmp_path)
    df = numbers(spark, 100).coalesce(1)
    append_parquet(df, base, "t", DAY, compression="GZIP", max_records=30)
    files = glob.glob(f"{base}/t/ingest_date=2024-06-01/batch_id=*/*.parquet")
    assert sorted(spark.read.parquet(f).count() for f in files) == [10, 30, 30, 30]
    assert all(".gz." in f for f in files)
    assert records_per_file(df.schema, 256) == 256 * 1024 * 1024 // 8


def test_batch_is_replaced(spark, tmp_path):
    base = str(tmp_path)
    write_batch(numbers(spark, 10), base, "t", "b1", DAY)
    write_batch(numbers(spark, 10, 10), base, "t", "b2", DAY)
    write_batch(numbers(spark, 7), base, "t", "b1", NEXT_DAY)
    rows = spark.read.parquet(f"{base}/t")
    assert sorted(r.x for r in rows.collect()) == list(range(7)) + list(range(10, 20))
    assert rows.filter("batch_id = 'b1' and ingest_date = '2024-06-01'").count() == 7


def test_batch_is_replaced_whatever_the_session_says(spark, tmp_path):
    base = str(tmp_path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_batch(numbers(spark, 10), base, "t", "b1", DAY)
        write_batch(numbers(spark, 7), base, "t", "b1", NEXT_DAY)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(f"{base}/t").count() == 7


def test_append_table(spark):
    name = f"cdc_{uuid.uuid4().hex}.t"
    append_table(numbers(spark, 3).selectExpr("x", "x * 2 as y"), name)
    append_table(numbers(spark, 2, 3).selectExpr("x * 2 as y", "x"), name)
    assert sorted((r.x, r.y) for r in spark.table(name).collect()) == [
        (i, 2 * i) for i in range(5)
    ]


def test_table_batch_is_replaced(spark):
    name = f"cdc_{uuid.uuid4().hex}.t"
    replace_batch(numbers(spark, 3), name, "b1")
    replace_batch(numbers(spark, 2, 3), name, "b2")
    replace_batch(numbers(spark, 1), name, "b1")
    got = sorted((r.batch_id, r.x) for r in spark.table(name).collect())
    assert got == [("b1", 0), ("b2", 3), ("b2", 4)]


@pytest.mark.parametrize("kind", ["parquet", "table"])
def test_destination(spark, tmp_path, kind):
    d = Destination(type=kind, base_path=str(tmp_path), table_namespace=f"n{uuid.uuid4().hex}")
    d.write_batch(numbers(spark, 4), "t", "b", DAY)
    d.write_batch(numbers(spark, 3), "t", "b", DAY)
    assert sorted(r.x for r in d.read(spark, "t").collect()) == [0, 1, 2]


def test_publish_frame(spark):
    df = spark.createDataFrame([("1", "{}", 5)], "key string, value string, extra int")
    assert publish_frame(df, "t").collect() == [("t", "1", "{}")]


@pytest.mark.parametrize("way", ["append", "batch"])
def test_new_columns_of_tables_are_kept(spark, way):
    name = f"n{uuid.uuid4().hex}.t"

    def write(df, batch):
        append_table(df, name) if way == "append" else replace_batch(df, name, batch)

    write(numbers(spark, 2), "b1")
    write(numbers(spark, 1, 2).selectExpr("concat('v', x) as v", "x"), "b2")
    write(numbers(spark, 1, 3), "b3")
    rows = sorted((r.x, r.v) for r in spark.table(name).collect())
    assert rows == [(0, None), (1, None), (2, "v2"), (3, None)]


@pytest.mark.parametrize("text", ["concat('k', id)", "concat(repeat(sha2(cast(id as string), 256), 20), sha2(cast(id + 1 as string), 512))"])
def test_files_are_sized_by_what_was_written(spark, tmp_path, text):
    """After a first batch cut by a guess, files are within a fifth of the wanted size, whether texts are narrow or wide."""
    base, wanted = str(tmp_path), 1
    rows = spark.range(60_000).selectExpr("id", f"{text} as text").coalesce(1)
    write_batch(rows.limit(3000), base, "t", "b0", DAY, file_size_mb=wanted)
    width = measured_width(spark, f"{base}/t")
    n = int(2.5 * wanted * 1024 * 1024 / width)
    big = spark.range(n).selectExpr("id", f"{text} as text").coalesce(1)
    for k in (1, 2):
        write_batch(big, base, "t", f"b{k}", DAY, file_size_mb=wanted)
    sizes = sorted(os.path.getsize(f) for f in glob.glob(f"{base}/t/*/batch_id=b2/*.parquet"))
    assert len(sizes) >= 3 and all(abs(s / (wanted * 1024 * 1024) - 1) < 0.2 for s in sizes[1:])
    assert spark.read.parquet(f"{base}/t").count() == 2 * n + 3000


def test_empty_and_repeated_batches_are_measured_once(spark, tmp_path):
    base = str(tmp_path)
    write_batch(numbers(spark, 0), base, "t", "none", DAY)
    write_batch(numbers(spark, 5).filter("false"), base, "t", "none2", DAY)
    assert measured_width(spark, f"{base}/t") is None
    for n in (5000, 2000):
        write_batch(numbers(spark, n), base, "t", "b", DAY)
    assert len(glob.glob(f"{base}/t/_sizes/b~2000~*")) == 1 and len(glob.glob(f"{base}/t/_sizes/*~*")) == 1
