import random

import pytest
from pyspark.sql import functions as F

from changelake.sources import snapshot as snap
from changelake.sources.snapshot import chunked_snapshot, quantile_chunks, snapshot_resume


@pytest.mark.parametrize("pages", [0, 1, 499, 500, 501, 1000, 1200, 1500, 1_200_000])
def test_chunk_plan(spark, pages):
    tables = spark.createDataFrame([("t", pages)], "table_name string, pages bigint")
    plan = snap.chunk_plan(tables).orderBy("chunk").collect()
    want, start = [], 0
    while start < pages:
        want.append((start, min(start + 500, pages + 1)))
        start += 500
    want = want or [(0, 1)]
    assert [(r.start_page, r.end_page) for r in plan] == want
    assert [r.chunk for r in plan] == list(range(len(want)))
    assert snap.page_chunks("ctid", pages).count == len(want)


def test_ranges_cover_everything_once(spark):
    keys = [None, -5, 0, 9, 10, 19, 20, 29, 30, 1000]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    chunks = snap.Chunks("k", 0, 10, 3)
    tagged = df.select("k", chunks.of().alias("c")).collect()
    assert {r.k: r.c for r in tagged} == {
        None: 0, -5: 0, 0: 0, 9: 0, 10: 1, 19: 1, 20: 2, 29: 2, 30: 2, 1000: 2,
    }
    for first in range(4):
        for last in range(first, 4):
            got = {r.k for r in df.filter(chunks.between(first, last)).collect()}
            assert got == {r.k for r in tagged if first <= r.c <= last}
    assert df.filter(chunks.between(2, 1)).count() == 0


def test_key_chunks(spark):
    df = spark.createDataFrame([(7,), (16,), (27,)], "k bigint")
    assert snap.key_chunks(df, "k", 10) == snap.Chunks("k", 7, 10, 3)
    assert snap.key_chunks(df.filter("k > 99"), "k", 10) == snap.Chunks("k", 0, 10, 1)


def test_resume_skips_what_is_done(spark):
    df = spark.range(95).withColumnRenamed("id", "k")
    chunks = snap.key_chunks(df, "k", 10)
    assert sorted(r.k for r in snap.snapshot_resume(df, chunks, 7).collect()) == list(range(70, 95))
    assert snap.snapshot_resume(df, chunks, 10).count() == 0


def test_ctid_predicates():
    chunks = snap.page_chunks("ctid", 1200)
    assert snap.ctid_predicates(chunks, 0, 9) == [
        "ctid >= '(0,0)'::tid AND ctid < '(500,0)'::tid",
        "ctid >= '(500,0)'::tid AND ctid < '(1000,0)'::tid",
        "ctid >= '(1000,0)'::tid",
    ]
    assert snap.ctid_predicates(chunks, 1, 1) == ["ctid >= '(500,0)'::tid AND ctid < '(1000,0)'::tid"]


def test_snapshot_scan(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "x bigint, y string, z double")
    out = snap.snapshot_scan(df, ["y", "x"], F.lit(None).cast("timestamp"))
    assert out.columns == ["y", "x", "_cdc_position", "_cdc_operation", "_cdc_timestamp"]
    assert tuple(out.first())[:4] == ("a", 1, 0, "SNAPSHOT")


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_quantile_chunks(spark, n):
    """Ranges of like size over a skewed key; values that fill a range have their own; scans find the same rows."""
    rnd = random.Random(n)
    keys = [int(rnd.paretovariate(0.5)) for _ in range(3000)] + [17] * 1500 + [-5] * 700 + [None] * 20
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    chunks = quantile_chunks(df, "k", n)
    got = [r for r in chunked_snapshot(df, chunks).groupBy("chunk").agg(F.count("*").alias("rows"), F.min("k").alias("low"), F.max("k").alias("high")).collect()]
    assert sum(r.rows for r in got) == len(keys) and {r.chunk for r in got} <= set(range(chunks.count))
    spread = sorted((r.low, r.high) for r in got if r.low is not None)
    assert all(a[1] < b[0] for a, b in zip(spread, spread[1:]))
    share = len(keys) / n
    assert all(r.rows <= 2 * share + 20 for r in got if r.low != r.high)
    if n == 40:
        assert any(r.low == r.high == 17 for r in got) and any(r.low == r.high == -5 for r in got)
    for first, last in ((0, 0), (n // 2, n - 1), (0, chunks.count - 1)):
        found = df.filter(chunks.between(first, last)).count()
        assert found == sum(r.rows for r in got if first <= r.chunk <= last)


def test_quantile_chunks_of_times_and_of_nothing(spark):
    df = spark.sql("select timestamp_seconds(id * id) as at from range(500)")
    chunks = quantile_chunks(df, "at", 5)
    rows = [r["count"] for r in chunked_snapshot(df, chunks).groupBy("chunk").count().collect()]
    assert len(rows) == 5 and max(rows) <= 200
    assert sum(snapshot_resume(df, chunks, n).count() for n in (0, chunks.count)) == 500
    none = quantile_chunks(df.limit(0), "at", 5)
    assert none.count == 1 and chunked_snapshot(df.limit(0), none).count() == 0 and chunked_snapshot(df, none).filter("chunk = 0").count() == 500
