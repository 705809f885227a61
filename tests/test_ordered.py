"""Block-wise ordered work against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from changelake.operators import ordered
from changelake.operators.ordered import carried_forward, nearest_markers, row_numbers


def stream(seed, size=400, span=3000):
    """Rows of three keys, one of which holds most of them, with negative order values too."""
    rnd = random.Random(seed)
    rows = []
    for seq in rnd.sample(range(-span, span), size):
        key = rnd.choices(["hot", "mild", "rare"], [90, 9, 1])[0]
        rows.append((key, seq, rnd.random() < 0.1))
    return rows


@pytest.mark.parametrize("width", [1, 7, 100, 100_000])
def test_nearest_markers(spark, width):
    rows = stream(width)
    df = spark.createDataFrame(rows, "k string, seq bigint, m boolean")
    got = nearest_markers(
        df.filter("not m"), df.filter("m"), ["k"], "seq", F.struct("seq"), "b", "a", width
    )
    found = {(r.k, r.seq): (r.b and r.b.seq, r.a and r.a.seq) for r in got.collect()}
    want = {}
    for key, seq, marker in rows:
        marks = [s for k, s, m in rows if k == key and m]
        if not marker:
            want[key, seq] = (
                max((s for s in marks if s < seq), default=None),
                min((s for s in marks if s > seq), default=None),
            )
    assert found == want
    assert got.columns == ["k", "seq", "m", "b", "a"]


def test_no_markers(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, seq bigint")
    got = nearest_markers(df, df.filter("false"), ["k"], "seq", F.struct("seq"), before="b")
    assert [(r.seq, r.b) for r in got.orderBy("seq").collect()] == [(1, None), (2, None)]


@pytest.mark.parametrize("width", [1, 13, 100_000])
def test_row_numbers(spark, width):
    rows = stream(width + 1)
    df = spark.createDataFrame(rows, "k string, seq bigint, m boolean")
    got = {(r.k, r.seq): r.n for r in row_numbers(df, ["k"], "seq", "n", width).collect()}
    want = {}
    for key in ("hot", "mild", "rare"):
        for n, seq in enumerate(sorted(s for k, s, _ in rows if k == key), 1):
            want[key, seq] = n
    assert got == want


@pytest.mark.parametrize("upper", [4, 65_536])
def test_row_numbers_of_null_keys(spark, monkeypatch, upper):
    """A null key is numbered like any other, with and without blocks of blocks."""
    monkeypatch.setattr(ordered, "UPPER_WIDTH", upper)
    rows = [(None if n % 3 else "a", n * n - 50) for n in range(60)] + [(None, 10_000)]
    df = spark.createDataFrame(rows, "k string, seq bigint")
    got = {(r.k, r.seq): r.n for r in row_numbers(df, ["k"], "seq", "n", 7).collect()}
    assert got == {(k, s): sum(o == k and q <= s for o, q in rows) for k, s in rows}
    assert row_numbers(df.limit(0), ["k"], "seq", "n").isEmpty()


def test_null_keys_are_a_key(spark):
    df = spark.createDataFrame([(None, n, n % 3 == 0) for n in range(40)] + [("a", 100, False)], "k string, seq bigint, m boolean")
    got = nearest_markers(df.filter("not m"), df.filter("m"), ["k"], "seq", F.struct("seq"), "b", "a", width=4)
    found = {(r.k, r.seq): (r.b and r.b.seq, r.a and r.a.seq) for r in got.collect()}
    want = {(None, n): (n // 3 * 3, n // 3 * 3 + 3 if n < 39 else None) for n in range(40) if n % 3}
    assert found == want | {("a", 100): (None, None)}


@pytest.mark.parametrize("rows", [1, 100])
def test_partitions_hold_bounded_numbers_of_rows(spark, monkeypatch, rows):
    """However many rows there are, a partition holds no more, and rows are shuffled and sorted no more often than that needs."""
    monkeypatch.setattr(ordered, "ROWS_OF_PART", 10)
    n = rows * 10 * spark.sparkContext.defaultParallelism
    df = spark.range(n).select(F.lit("s").alias("k"), F.col("id").alias("seq"), (F.col("id") % 3 == 0).alias("m"))
    got = nearest_markers(df.filter("not m"), df.filter("m"), ["k"], "seq", F.struct("seq"), "b", "a", width=2)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert ("REPARTITION_BY_NUM" in text) == (rows > 1)
    # Rows are not shuffled again for the join with what crosses the borders.
    again = [line for line in text.splitlines() if "Exchange hashpartitioning(coalesce(" in line]
    assert all("_upper" in line for line in again)
    if rows > 1:
        held = df.count() / int(re.search(r"hashpartitioning\(_place#\d+, (\d+)\), REPARTITION_BY_NUM", text)[1])
        assert held <= 10


def test_carried_forward(spark):
    df = spark.range(1000).select(F.lit("s").alias("k"), F.col("id").alias("seq"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    got = carried_forward(df, ["k"], "seq", {"c": F.col("v")}, width=16)
    assert got.columns == ["k", "seq", "v", "c"]
    assert [(r.seq, r.c) for r in got.orderBy("seq").collect()] == [(n, n // 7 * 7) for n in range(1000)]
