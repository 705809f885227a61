"""Sets of places as intervals against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.operators.intervals import border_marks, islands, merged, outside

SCHEMA = "k string, seq bigint, m string"
MARK = F.struct


def places(seed, size=300, span=500):
    rnd = random.Random(seed)
    chosen = {(rnd.choice("aaab"), rnd.randrange(-span, span)) for _ in range(size)}
    return [(k, s, rnd.choice(["B", "C", None])) for k, s in sorted(chosen)]


def sets(rows):
    """Maximal runs: key, from, to, first and last mark."""
    out = []
    for k, s, m in sorted(rows, key=lambda r: (r[0], r[1])):
        if out and out[-1][0] == k and out[-1][2] == s - 1:
            out[-1][2] = s
        else:
            out.append([k, s, s, None, None])
        if m:
            out[-1][3] = out[-1][3] or (s, m)
            out[-1][4] = (s, m)
    return [tuple(o) for o in out]


def found(df):
    return sorted((r.k, r.seq_from, r.seq_to, r.first_mark and tuple(r.first_mark), r.last_mark and tuple(r.last_mark)) for r in df.collect())


def as_islands(spark, rows, width):
    df = spark.createDataFrame(rows, SCHEMA)
    return islands(df, ["k"], "seq", F.when(F.col("m").isNotNull(), F.struct("seq", "m")), width)


@pytest.mark.parametrize("width", [1, 65_536])
def test_islands_merge_to_maximal_runs(spark, width):
    rows = places(width)
    found_ = as_islands(spark, rows, width)
    assert found(merged(found_, ["k"], width)) == sets(rows)
    # Sets that were found apart from each other, in any order.
    rnd = random.Random(1)
    rnd.shuffle(rows)
    parts = as_islands(spark, rows[::2], width).unionByName(as_islands(spark, rows[1::2], width))
    assert found(merged(parts, ["k"], width)) == sets(rows)


@pytest.mark.parametrize("width", [7, 65_536])
def test_outside(spark, width):
    rows = places(width + 1)
    asked = spark.createDataFrame([(k, s, "x") for k in "abc" for s in range(-505, 505, 3)], SCHEMA)
    inside = {r[:2] for r in rows}
    got = outside(asked, as_islands(spark, rows, width), ["k"], "seq", width)
    assert got.columns == asked.columns
    assert {(r.k, r.seq) for r in got.collect()} == {(r.k, r.seq) for r in asked.collect()} - inside


def test_no_places(spark):
    none = as_islands(spark, places(1), 10).limit(0)
    asked = spark.createDataFrame([("a", 1, None)], SCHEMA)
    assert merged(none, ["k"]).collect() == [] and outside(asked, none, ["k"], "seq").count() == 1


def test_border_marks(spark):
    rows = [("a", 1, "B"), ("a", 2, None), ("a", 3, "C"), ("a", 4, "B"), ("a", 5, "C"), ("a", 9, "B"), ("a", 20, None)]
    marks = border_marks(as_islands(spark, rows, 100), ["k"]).collect()
    assert sorted((r.seq, r.m) for r in marks) == [(1, "B"), (5, "C"), (9, "B")]
