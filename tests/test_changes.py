import random

import pytest
from pyspark.sql import functions as F

from changelake.functions.types import Field
from changelake.operators import changes as chg
from changelake.operators import records as rec
from changelake.operators.transactions import assemble_transactions, commit_positions
from changelake.plans.change_log import committed_changes, table_changes


def message(seq, kind, stream="s", oid=None, table=None, columns=None, old=None, new=None,
            xid=None, lsn=None):
    namespace, _, name = (table or "").partition(".")
    return (
        stream, seq, lsn or f"0/{seq:X}" if seq >= 0 else None, kind, xid, oid, namespace or None,
        name or None, columns, old, new, None,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, chg.MESSAGE_SCHEMA)


def t(*texts):
    return [("t", x) for x in texts]


def random_log(seed, relations):
    """A log of three streams and four oids; streams are hot in different measure."""
    rnd = random.Random(seed)
    rows = []
    for seq in range(300):
        stream = rnd.choices(["a", "b", "c"], [8, 1, 1])[0]
        oid = rnd.choice([1, 1, 1, 2, 3, 4])
        if rnd.random() < relations:
            rows.append(message(seq, "R", stream, oid, f"n.t{oid}_{seq}", [f"c{seq}"]))
        else:
            rows.append(message(seq, "I", stream, oid, new=t("x")))
    return rows


def latest_name(rows, row):
    best = None
    for r in rows:
        if r[3] == "R" and r[0] == row[0] and r[5] == row[5] and r[1] < row[1]:
            if best is None or r[1] > best[1]:
                best = r
    return f"{best[6]}.{best[7]}" if best else f"unknown.{row[5]}"


@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_relation(spark, seed):
    rows = random_log(seed, 0.15)
    got = chg.resolve_relation(frame(spark, rows), width=16).collect()
    want = {(r[0], r[1]): latest_name(rows, r) for r in rows if r[3] == "I"}
    assert {(r.stream_id, r.seq): r.table_name for r in got} == want


def test_relations_of_earlier_batches(spark):
    old = frame(spark, [message(1, "R", oid=5, table="n.old", columns=["a"])])
    log = frame(spark, [message(10, "I", oid=5, new=t("1")), message(11, "I", oid=6, new=t("1"))])
    got = {r.seq: r.table_name for r in chg.resolve_relation(log, old).collect()}
    assert got == {10: "n.old", 11: "unknown.6"}


def test_tuple_to_columns(spark):
    rows = [
        (1, t("1", "2"), ["a", "b"]),
        (2, t("1", "2", "3"), ["a"]),
        (3, [("n", None), ("u", None), ("t", "")], ["a", "b", "c"]),
        (4, t("1"), None),
        (5, t("first", "x", "last"), ["col_2", "b"]),
        (6, [("t", "1"), ("b", "binary")], ["a", "b"]),
        (7, [], ["a"]),
        (8, None, ["a"]),
    ]
    df = spark.createDataFrame(
        rows, "i int, v array<struct<kind:string,text:string>>, n array<string>"
    )
    got = df.select("i", chg.tuple_to_columns(F.col("v"), F.col("n")).alias("m")).orderBy("i")
    assert [r.m for r in got.collect()] == [
        {"a": "1", "b": "2"},
        {"a": "1", "col_1": "2", "col_2": "3"},
        {"a": None, "b": None, "c": ""},
        {"col_0": "1"},
        {"b": "x", "col_2": "last"},
        {"a": "1"},
        {},
        None,
    ]


def test_before_after_and_image(spark):
    log = frame(
        spark,
        [
            message(0, "R", oid=1, table="n.t", columns=["id", "v"]),
            message(1, "I", oid=1, new=t("1", "a")),
            message(2, "U", oid=1, new=t("1", "b")),
            message(3, "U", oid=1, old=t("1"), new=t("2", "b")),
            message(4, "D", oid=1, old=t("2")),
        ],
    )
    images = chg.row_image(chg.before_after(chg.resolve_relation(log)))
    got = {r.seq: (r.after, r.before, r.image) for r in images.collect()}
    assert got == {
        1: ({"id": "1", "v": "a"}, None, {"id": "1", "v": "a"}),
        2: ({"id": "1", "v": "b"}, None, {"id": "1", "v": "b"}),
        3: ({"id": "2", "v": "b"}, {"id": "1"}, {"id": "2", "v": "b"}),
        4: (None, {"id": "2"}, {"id": "2"}),
    }


def test_image_columns_agree_with_the_map_form(spark):
    fields = [Field("a", "INT64"), Field("b"), Field("col_1"), Field("col_2"), Field("zz")]
    log = frame(
        spark,
        [
            message(0, "R", oid=1, table="n.t", columns=["b", "a"]),
            message(1, "R", oid=2, table="n.u", columns=["a"]),
            message(2, "I", oid=1, new=t("x", "5")),
            message(3, "I", oid=2, new=[("t", "7"), ("t", "p"), ("u", None)]),
            message(4, "D", oid=3, old=t("q", "r", "s")),
            message(5, "I", oid=1, new=t("only")),
        ],
    )
    resolved = chg.resolve_relation(log)
    direct = resolved.select("seq", *chg.image_columns(fields))
    images = chg.row_image(chg.before_after(resolved))
    by_map = images.select("seq", *rec.project_image(F.col("image"), fields))
    assert sorted(direct.collect()) == sorted(by_map.collect())
    assert direct.schema == by_map.schema


def test_transactions(spark):
    log = frame(
        spark,
        [
            message(1, "I", oid=1),  # before any BEGIN
            message(2, "B", xid=7), message(3, "I", oid=1), message(4, "D", oid=1),
            message(5, "C", lsn="0/AA"),
            message(6, "I", oid=1),  # between transactions
            message(7, "B", xid=8), message(8, "I", oid=1),  # started over
            message(9, "B", xid=8), message(10, "I", oid=1), message(11, "C"),
            message(12, "B", xid=7), message(13, "U", oid=1),  # open, and xid 7 again
            message(3, "I", "other", oid=1), message(4, "C", "other"),  # no BEGIN there
        ],
    )
    for width in (1, 4, 1000):
        got = assemble_transactions(log, width=width).collect()
        assert sorted((r.stream_id, r.seq, r.tx_xid, r.commit_seq, r.commit_lsn) for r in got) == [
            ("s", 3, 7, 5, "0/AA"), ("s", 4, 7, 5, "0/AA"), ("s", 10, 8, 11, "0/B"),
        ]


def test_commit_positions(spark):
    log = frame(spark, [message(1, "C", lsn="1/0"), message(2, "C", lsn="0/FF")])
    targets = spark.createDataFrame([("n.t",), ("n.u",)], "table_name string")
    got = sorted((r.table_name, r.last_position, r.last_lsn) for r in commit_positions(log, targets).collect())
    assert got == [("n.t", 4294967296, "1/0"), ("n.u", 4294967296, "1/0")]


def test_table_changes_and_rejects(spark):
    fields = [Field("id", "INT64", False, True), Field("v", "STRING", False)]
    log = frame(
        spark,
        [
            message(0, "R", oid=1, table="n.t", columns=["id", "v"]),
            message(1, "B"),
            message(2, "I", oid=1, new=t("1", "a")),
            message(3, "I", oid=1, new=[("t", "2"), ("n", None)]),
            message(4, "D", oid=1, old=[("t", "1"), ("n", None)]),
            message(5, "I", oid=9, new=t("1")),
            message(6, "C"),
        ],
    )
    targets = spark.createDataFrame([("n.t",)], "table_name string")
    changes = committed_changes(log, targets, F.lit(None).cast("timestamp"))
    good, rejected = rec.split_rejects(table_changes(changes, "n.t", fields))
    assert {(r._cdc_position, r._cdc_operation) for r in good.collect()} == {
        (2, "INSERT"), (4, "DELETE"),
    }
    assert [(r.id, r._reject_reason) for r in rejected.collect()] == [(2, "v")]


def test_fail_on_rejects(spark):
    fields = [Field("id", "INT64", False)]
    df = spark.createDataFrame([(1,), (None,)], "id bigint")
    with pytest.raises(Exception, match="null in required column: id"):
        rec.fail_on_rejects(rec.enforce_required(df, fields)).collect()
    ok = rec.fail_on_rejects(rec.enforce_required(df.filter("id = 1"), fields))
    assert ok.collect() == [(1,)]
