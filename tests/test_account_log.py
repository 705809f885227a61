"""The account log that the queries on states are run over."""

import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.functions.positions import parse_lsn
from changelake.queries import inputs
from changelake.queries.checks import CHECKS
from changelake.queries.registry import QUERIES
from tests.compare import TABLES, compare, duck

SF_DIR = "/root/testdata/sf0.001"
# Orders 131,070 and 131,071 are on either side of a place where `lsn_text` wraps.
FIRST, LAST = 130_900, 131_073


@pytest.fixture(scope="module")
def wrap_dir(spark, tmp_path_factory):
    """Orders of ten customers around such a place, which is the last of one of them, and some long before; the first range of a load finds none of its rows."""
    folder = tmp_path_factory.mktemp("wrap")
    for t in TABLES:
        if t != "orders":
            shutil.copy(f"{SF_DIR}/{t}.parquet", folder)
    n = F.col("id")
    rows = spark.range(50).union(spark.range(70_000, 70_030)).union(spark.range(FIRST, LAST)).select(
        n.alias("o_orderkey"), (n % 10 + 1).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (n * 1.5).alias("o_totalprice"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    rows.coalesce(1).toPandas().to_parquet(folder / "orders.parquet", coerce_timestamps="us")
    return str(folder)


def test_positions_ascend_with_the_log(spark, wrap_dir):
    log = inputs.account_changes(spark, wrap_dir).filter("lsn is not null").select("seq", parse_lsn(F.col("lsn")).alias("at"))
    fell = F.lag("at").over(Window.orderBy("seq")) > F.col("at")
    assert log.filter("at is null").isEmpty() and log.select(fell.alias("fell")).filter("fell").isEmpty()


@pytest.mark.parametrize("name", ["q_current_state", "q_reconciled_load"])
def test_states_where_positions_wrapped(spark, wrap_dir, name):
    assert compare(spark, duck(wrap_dir), wrap_dir, QUERIES[name], CHECKS[name]) is None
