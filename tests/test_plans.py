"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from changelake.operators import changes as chg
from changelake.operators.ordered import row_numbers
from changelake.queries.registry import QUERIES
from changelake.sources import snapshot as snap
from tests.test_changes import frame, message

SF_DIR = "/root/testdata/sf0.001"
# These write to a sink; their plan is the read back.
JOBS = {"q_append", "q_replay", "q_topic_sync", "q_table_sync"}


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in JOBS])
def test_no_cross_joins_and_no_python(spark, name):
    text = physical(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


@pytest.mark.parametrize(
    "name,columns",
    [
        ("q_snapshot", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]),
        ("q_project", ["o_orderkey", "o_custkey"]),
        ("q_watermark", ["event_id", "user_id"]),
        ("q_envelope", ["event_id", "ts", "user_id", "props"]),
        ("q_topic_change_log", ["event_id", "ts", "user_id", "props"]),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    text = physical(QUERIES[name](spark, SF_DIR))
    schema = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert all({c.split(":")[0] for c in s.split(",")} == set(columns) for s in schema) and schema
    assert "Exchange" not in text or name == "q_watermark"


def test_topic_log_parses_json_once(spark):
    text = physical(QUERIES["q_topic_change_log"](spark, SF_DIR))
    assert "Exchange" not in text


def test_resume_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    rest = snap.snapshot_resume(orders, snap.Chunks("o_orderkey", 0, 100, 15), 7)
    assert "GreaterThanOrEqual(o_orderkey,700)" in physical(rest)


def test_watermark_combines_before_the_shuffle(spark):
    assert "partial_max" in physical(QUERIES["q_watermark"](spark, SF_DIR))


def test_row_numbers_shuffle_rows_once(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = physical(row_numbers(df, ["k"], "id", "n"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the rows, one for the block counts, and those again by key and back by block.
    assert text.count("Exchange hashpartitioning") <= 4
    assert "SinglePartition" not in text


def test_relations_are_not_broadcast(spark):
    rows = [message(n, "R", oid=1, table="n.t", columns=["a"]) for n in range(3)]
    rows.append(message(5, "I", oid=1))
    text = physical(chg.resolve_relation(frame(spark, rows)))
    assert "BroadcastHashJoin" not in text and "Window" in text
