"""State of tables against a replay in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.functions.types import Field
from changelake.operators import state as sta
from changelake.operators.changes import MESSAGE_SCHEMA
from changelake.plans.change_log import committed_changes
from changelake.plans.current_table import EVENT_TYPES, CurrentTable
from changelake.sinks import folders

FIELDS = [Field("id", "INT64"), Field("a", "STRING"), Field("b", "INT64")]
SCHEMA = ", ".join(f"{n} {t}" for n, t in EVENT_TYPES.items()) + ", id bigint, a string, b bigint"


def history(seed, size=300, keys=6, truncates=True, whole_moves=False):
    """A well-formed log of a table (seq, op, key, old key, {column: value} of what it carries), and the table after each of its changes."""
    rnd = random.Random(seed)
    table, log, states = {}, [], []
    for seq in range(size):
        key = rnd.choices(range(keys), [20] + [1] * (keys - 1))[0]
        if truncates and rnd.random() < 0.01:
            table.clear()
            log.append((seq, "T", None, None, {}))
        elif key not in table:
            table[key] = {"a": rnd.choice(["x", "y", None]), "b": rnd.choice([1, 2, None])}
            log.append((seq, "I", key, None, dict(table[key])))
        elif rnd.random() < 0.15:
            del table[key]
            log.append((seq, "D", key, None, {}))
        else:
            given = {c: rnd.choice(v) for c, v in (("a", ["p", "q", None]), ("b", [7, 8, None])) if rnd.random() < 0.4}
            to = rnd.choice([k for k in range(keys) if k not in table] + [key]) if rnd.random() < 0.5 else key
            if whole_moves and to != key:
                given = table[key] | given
            table[to] = table.pop(key) | given
            log.append((seq, "U", to, key if to != key else None, given))
        states.append({k: (v["a"], v["b"]) for k, v in table.items()})
    return log, states


def frame(spark, log):
    rows = []
    for seq, op, key, old, given in log:
        left = [c for c in ("a", "b") if c not in given] if op in "IU" else None
        rows.append(("s", seq, seq // 3, op, None if key is None else [str(key)], None if old is None else [str(old)], left, None, key, given.get("a"), given.get("b")))
    return spark.createDataFrame(rows, SCHEMA)


def table(df):
    rows = [(r.id, (r.a, r.b)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.mark.parametrize("seed", range(4))
def test_current_state(spark, seed):
    log, states = history(seed)
    events = frame(spark, log)
    assert table(sta.current_state(events.repartition(5), FIELDS)) == states[-1]
    # Repeated deliveries change nothing.
    assert table(sta.current_state(events.unionByName(events), FIELDS)) == states[-1]


@pytest.mark.parametrize("width", [2, 40, 100_000])
def test_unchanged_values(spark, width):
    """Every update has the values of the row before it, through chains of changed keys."""
    log, states = history(11, 250, truncates=False)
    got = {r._seq: r for r in sta.fill_unchanged(frame(spark, log).repartition(4), FIELDS, width).collect()}
    assert len(got) == len(log)
    assert sum(old is not None and len(given) < 2 for _, _, _, old, given in log) > 10
    for seq, op, key, _, _ in log:
        if op in "IU":
            assert (got[seq].a, got[seq].b) == states[seq][key] and got[seq]._unchanged == []


def test_long_chain_of_keys(spark):
    log = [(0, "I", 0, None, {"a": "first", "b": 1})] + [(i, "U", i, i - 1, {"b": i} if i % 5 == 0 else {}) for i in range(1, 70)]
    got = {r._seq: (r.a, r.b) for r in sta.fill_unchanged(frame(spark, log), FIELDS).collect()}
    assert got == {i: ("first", i // 5 * 5 or 1) for i in range(70)}
    assert table(sta.current_state(frame(spark, log), FIELDS)) == {69: ("first", 65)}


def test_values_never_told(spark):
    log = [(1, "U", 5, None, {"a": "x"}), (2, "U", 6, 5, {"a": "y"}), (3, "U", 8, 7, {})]
    rows = {r._seq: (r.a, r.b, r._unchanged) for r in sta.fill_unchanged(frame(spark, log), FIELDS).collect()}
    assert rows == {1: ("x", None, ["b"]), 2: ("y", None, []), 3: (None, None, [])}
    assert table(sta.current_state(frame(spark, log), FIELDS)) == {6: ("y", None), 8: (None, None)}


def test_no_events(spark):
    none = frame(spark, [(1, "I", 1, None, {"a": "x", "b": 1})]).limit(0)
    assert sta.current_state(none, FIELDS).collect() == sta.fill_unchanged(none, FIELDS).collect() == []


def test_null_keys_are_one_key(spark):
    rows = [("s", i, i, "I", [None], None, [], None, None, f"v{i}", i) for i in range(3)]
    assert table(sta.current_state(spark.createDataFrame(rows, SCHEMA), FIELDS)) == {None: ("v2", 2)}


@pytest.mark.parametrize("seed", range(3))
def test_batches(spark, tmp_path, seed):
    """Batch after batch gives the state after each, whatever died in between."""
    log, states = history(20 + seed, 240)
    kept = CurrentTable(str(tmp_path), FIELDS, 8)
    for first in range(0, 240, 60):
        batch = frame(spark, log[first : first + 60])
        if first == 120:
            # Killed after the buckets were written, before the pointer was swapped: nothing has changed, and the repeat is not in its way.
            swap, kept._swap = kept._swap, lambda *a: (_ for _ in ()).throw(InterruptedError())
            with pytest.raises(InterruptedError):
                kept.apply(batch)
            assert table(kept.read(spark)) == states[first - 1]
            kept._swap = swap
        version = kept.apply(batch)
        assert table(kept.read(spark)) == states[first + 59]
    kept.apply(frame(spark, log[60:120]))
    assert table(kept.read(spark)) == states[-1]
    kept.forget_deleted(spark, 1000)
    assert table(kept.read(spark)) == states[-1] and kept.events(spark).filter("_op = 'D'").isEmpty()
    assert len(folders.numbered(spark, f"{tmp_path}/pointers", "v=")) == 3 and version == 3


def test_batches_in_any_order(spark, tmp_path):
    """Without changes of key, batches may come in any order."""
    log, states = history(31, 120)
    log = [e for e in log if e[3] is None]
    replay = {}
    for _, op, key, _, given in log:
        if op == "T":
            replay.clear()
        elif op == "D":
            replay.pop(key, None)
        elif op == "I" or key in replay:
            replay[key] = (replay.get(key, {}) if op == "U" else {}) | given
    want = table(sta.current_state(frame(spark, log), FIELDS))
    kept = CurrentTable(str(tmp_path), FIELDS, 4)
    for part in (log[60:], log[:30], log[30:60]):
        kept.apply(frame(spark, part))
    assert table(kept.read(spark)) == want
    assert {k: v for k, v in want.items() if k in replay} == {k: (v.get("a"), v.get("b")) for k, v in replay.items()}


def test_only_touched_buckets_are_written(spark, tmp_path):
    kept = CurrentTable(str(tmp_path), FIELDS, 16)
    kept.apply(frame(spark, [(i, "I", i, None, {"a": "x", "b": i}) for i in range(100)]))
    kept.apply(frame(spark, [(200, "U", 5, None, {"b": 0})]))
    assert len(folders.numbered(spark, f"{tmp_path}/data/v=1", "bucket=")) == 1
    assert table(kept.read(spark))[5] == ("x", 0) and kept.read(spark).count() == 100
    kept.apply(frame(spark, [(300, "T", None, None, {})]))
    assert kept.read(spark).isEmpty() and not folders.numbered(spark, f"{tmp_path}/data/v=2", "bucket=")


def test_events_from_messages(spark):
    """Old tuples with keys only or whole rows, keys left unchanged, TRUNCATEs, and what was not committed."""
    t, n, u = (lambda x: ("t", x)), ("n", None), ("u", None)
    columns = ["id", "a", "b"]

    def message(seq, kind, **values):
        row = {"stream_id": "s", "seq": seq, "lsn": "0/10", "msg_type": kind, "xid": 1, "rel_oid": 5} | values
        return tuple(row.get(c) for c in MESSAGE_SCHEMA.names)

    log = spark.createDataFrame(
        [
            message(0, "R", rel_namespace="p", rel_table="t", rel_columns=columns), message(1, "B"),
            message(2, "I", new_tuple=[t("1"), t("x"), t("01")]), message(3, "U", old_tuple=[t("1"), n, n], new_tuple=[t("2"), u, t("5")]),
            message(4, "U", old_tuple=[t("2"), t("x"), t("5")], new_tuple=[u, t("y"), u]), message(5, "D", old_tuple=[t("2"), n, n]),
            message(6, "T"), message(7, "T", rel_oid=None), message(8, "C"), message(9, "B"), message(10, "T"),
        ],
        MESSAGE_SCHEMA,
    )
    changes = committed_changes(log, ["p.t"], F.current_timestamp(), truncates=True)
    got = [(r._seq, r._op, r._key, r._from, r._unchanged, r.id, r.a, r.b) for r in sta.table_events(changes, FIELDS, ["id"]).orderBy("_seq").collect()]
    assert got == [
        (2, "I", ["1"], None, [], 1, "x", 1), (3, "U", ["2"], ["1"], ["a"], 2, None, 5), (4, "U", ["2"], None, ["b"], 2, "y", None),
        (5, "D", ["2"], None, None, 2, None, None), (6, "T", None, None, None, None, None, None),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_load_under_changes(spark, seed):
    """Ranges read while the table changes, each at a time of its own between its marks: with the log one state, whatever comes first."""
    log, states = history(40 + seed, 200, keys=12, whole_moves=True)
    rnd = random.Random(seed)
    position = lambda s: s // 3
    rows, marks = [], {}
    for chunk in range(4):
        read = rnd.randrange(30, 150)
        low, high = position(read - rnd.randrange(20)) - 1, position(read + rnd.randrange(20)) + 1
        marks[chunk] = (low, high)
        rows += [(k, *v, chunk, low, high) for k, v in states[read].items() if k // 3 == chunk]
    df = spark.createDataFrame(rows, "id bigint, a string, b bigint, chunk int, low bigint, high bigint")
    events = frame(spark, log)
    snap = sta.snapshot_events(df, FIELDS, ["id"], F.lit("s"), F.col("low")).withColumns({"_low": F.col("_position"), "_high": F.lit(0).cast("bigint")})
    high = spark.createDataFrame([(c, h) for c, (_, h) in marks.items()], "c int, h bigint")
    ids = snap.withColumn("c", (F.col("id") / 3).cast("int")).join(high, "c").withColumn("_high", F.col("h"))
    # The log is applied from the lowest mark on; what is before it is in the ranges.
    after = events.filter(F.col("_position") > min(low for low, _ in marks.values()))
    both = ids.select(*after.columns).unionByName(after)
    assert table(sta.current_state(both, FIELDS)) == states[-1]
    # As a log: values filled first, then the overtaken rows dropped.
    kept = sta.reconcile(ids, events)
    changed = {(k, position(e[0])) for e in log for k in (e[2], e[3]) if k is not None}
    want = {r[0] for r in rows if not any(k == r[0] and r[4] < p <= r[5] for k, p in changed)}
    assert {r.id for r in kept.collect()} == want and len(want) < len(rows)
    filled = sta.fill_unchanged(both, FIELDS)
    told = filled.filter("_op <> 'S'").unionByName(filled.filter("_op = 'S'").join(kept.select("_key"), "_key", "left_semi").select(*filled.columns))
    assert table(sta.current_state(told, FIELDS)) == states[-1]
