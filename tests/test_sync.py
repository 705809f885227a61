"""Whole syncs: load, then changes; resumed, refreshed, routed."""

import datetime as dt
import glob
import os

import pytest

from changelake.functions.types import Field
from changelake.operators.progress import STREAM_SCHEMA
from changelake.plans.config import Destination, Stream, catalog_frame
from changelake.plans.current_table import CurrentTable
from changelake.plans.full_load import full_load
from changelake.plans.progress_store import GLOBAL, ProgressStore
from changelake.plans.sync import start_positions, sync
from changelake.session import small_frame
from changelake.sources.tables import FileTables, fields_by_table
from tests.test_changes import frame, message, t
from tests.test_streams import land

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def clock():
    return NOW


@pytest.fixture
def world(spark, tmp_path):
    root = str(tmp_path)
    a = spark.range(100).selectExpr("id", "cast(id as string) as v")
    a.repartition(10).write.parquet(f"{root}/a")
    b = spark.range(10).selectExpr("id", "id / 2D as extra")
    b.coalesce(1).write.parquet(f"{root}/b")
    spark.range(5).write.parquet(f"{root}/c")
    source = FileTables({f"n.{x}": f"{root}/{x}" for x in "abc"}, {f"n.{x}": "id" for x in "abc"})
    land(
        frame(
            spark,
            [
                message(1, "B"), message(2, "R", oid=1, table="n.a", columns=["id", "v"]),
                message(3, "I", oid=1, new=t("1", "early")), message(4, "C"),
            ],
        ),
        f"{root}/in",
    )
    return root, source, Destination(base_path=f"{root}/out"), ProgressStore(f"{root}/state")


STREAMS = [
    Stream("n.a", destination_table="a_log"),
    Stream("n.b", sync_mode="full_load"),
    Stream("n.missing"),
]


def run(spark, world, **options):
    root, source, destination, store = world
    return sync(
        spark, source, f"{root}/in", destination, STREAMS, store, clock=clock, **options
    )


def later_changes(spark, root):
    land(
        frame(
            spark,
            [
                message(5, "B"), message(6, "R", oid=1, table="n.a", columns=["id", "v"]),
                message(7, "U", oid=1, new=t("2", "late")),
                message(8, "I", oid=2, new=t("2", "late")), message(9, "C"),
            ],
        ),
        f"{root}/in",
    )


def operations(spark, destination, table):
    rows = destination.read(spark, table).groupBy("_cdc_operation").count().collect()
    return {r[0]: r[1] for r in rows}


def test_sync_twice(spark, world):
    root, _, destination, store = world
    assert run(spark, world, chunks_per_wave=4) == {"n.a": 10, "n.b": 1}
    # What was committed before the load is in the load, not in the changes.
    assert operations(spark, destination, "a_log") == {"SNAPSHOT": 100}
    assert operations(spark, destination, "b") == {"SNAPSHOT": 10}
    later_changes(spark, root)
    assert run(spark, world) == {}
    assert operations(spark, destination, "a_log") == {"SNAPSHOT": 100, "UPDATE": 1}
    saved = {r.stream_id: r for r in store.load(spark).streams.collect()}
    assert saved["n.a"].full_load_completed and saved["n.a"].full_load_chunks_total == 10
    assert saved["n.a"].sync_mode == "cdc" and saved["n.b"].sync_mode == "full_load"
    assert saved["n.a"].last_position == 9


def test_full_refresh(spark, world):
    root, _, destination, store = world
    run(spark, world)
    later_changes(spark, root)
    assert run(spark, world, full_refresh=True) == {"n.a": 10, "n.b": 1}
    # An append-only log keeps the first load and gets a second one.
    assert operations(spark, destination, "a_log") == {"SNAPSHOT": 200}
    assert store.generation(spark) == 1


def test_position_taken_over(spark, world):
    """Progress from elsewhere: changes after its global position are taken, others are not."""
    root, _, destination, store = world
    later_changes(spark, root)
    row = (GLOBAL, None, "0/4", 4, None, None, None, NOW)
    done = ("n.a", "cdc", "0/4", 4, True, 10, 10, NOW)
    store.update(spark, streams=small_frame(spark, [row, done], STREAM_SCHEMA))
    assert run(spark, world) == {"n.b": 1}
    assert operations(spark, destination, "a_log") == {"UPDATE": 1}
    assert start_positions(spark, None, store, NOW) == {"s": 4}


def test_from_earliest(spark, world):
    _, _, destination, _ = world
    run(spark, world, from_earliest=True)
    assert operations(spark, destination, "a_log") == {"SNAPSHOT": 100, "INSERT": 1}


def test_load_resumes(spark, world, monkeypatch):
    _, source, destination, store = world
    fields = [Field("id", "INT64", False, True), Field("v")]
    original, calls = Destination.write_batch, []

    def failing(self, *args):
        calls.append(1)
        original(self, *args)
        if len(calls) == 3:
            raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(Destination, "write_batch", failing)
        with pytest.raises(RuntimeError):
            full_load(spark, source, "n.a", fields, destination, "a_log", store, NOW, 2)
    saved = store.load(spark).streams.filter("stream_id = 'n.a'").first()
    assert (saved.full_load_chunks_done, saved.full_load_chunks_total) == (4, 10)
    assert not saved.full_load_completed
    assert full_load(spark, source, "n.a", fields, destination, "a_log", store, NOW, 2) == 6
    rows = destination.read(spark, "a_log")
    assert sorted(r.id for r in rows.collect()) == list(range(100))
    assert {r._cdc_position for r in rows.collect()} == {0}


def test_file_tables(spark, world):
    _, source, _, _ = world
    fields = fields_by_table(source.discover(spark))
    assert fields["n.b"] == [Field("id", "INT64", False, True), Field("extra", "DOUBLE")]
    ranges = source.ranges(spark, "n.a", fields["n.a"])
    assert ranges.count == 10
    parts = [{r.id for r in ranges.read(n, n).collect()} for n in range(10)]
    assert sorted(i for p in parts for i in p) == list(range(100))
    assert {r.id for r in ranges.read(3, 4).collect()} == parts[3] | parts[4]


def test_files_that_come_and_go_during_a_load(spark, world, tmp_path):
    root, source, _, _ = world
    fields = [Field("id", "INT64", False, True), Field("v")]
    listing = f"{tmp_path}/listing"
    begun = source.ranges(spark, "n.a", fields, listing=listing)
    early = {r.id for r in begun.read(0, 4).collect()}
    more = spark.range(100, 105).selectExpr("id", "cast(id as string) as v")
    more.coalesce(1).write.mode("append").parquet(f"{root}/a")
    new = max(glob.glob(f"{root}/a/*.parquet"), key=os.path.getmtime)
    os.utime(new, (1, 1))  # a name and time before all others
    ranges = source.ranges(spark, "n.a", fields, 10, listing)
    assert ranges.count == 10 and {r.id for r in ranges.read(0, 4).collect()} == early
    last = {r.id for r in ranges.read(9, 9).collect()}
    assert set(range(100, 105)) < last
    first = {r.id for r in ranges.read(0, 8).collect()}
    assert first | last == set(range(105)) and not first & last
    old = ranges.read(3, 3).inputFiles()[0].removeprefix("file://")
    os.truncate(old, 10)
    with pytest.raises(FileNotFoundError):
        ranges.read(2, 4)


def test_types_of_file_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("select 1S as s, 2Y as b, 1.50BD as d, cast(3 as decimal(38,18)) as w, 'x' as t, array('a') as l")
    df.write.parquet(path)
    got = fields_by_table(FileTables({"n.t": path}, {"n.t": ("s", "b")}).discover(spark))["n.t"]
    assert [(f.name, f.type) for f in got] == [
        ("s", "INT32"), ("b", "INT32"), ("d", "DECIMAL(3,2)"), ("w", "DECIMAL"), ("t", "STRING"), ("l", "ARRAY")
    ]
    assert [f.primary_key for f in got[:3]] == [True, True, False]
    spark.sql("select named_struct('a', 1) as s").write.parquet(f"{path}2")
    with pytest.raises(ValueError):
        FileTables({"n.t": f"{path}2"}, {}).discover(spark)


def test_missing_streams_are_refused_on_demand(spark, world):
    with pytest.raises(ValueError):
        run(spark, world, missing="fail")


def test_partitioned_files(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(20).selectExpr("id", "id % 3 as part")
    df.write.partitionBy("part").parquet(path)
    source = FileTables({"n.p": path}, {"n.p": "id"})
    fields = fields_by_table(source.discover(spark))["n.p"]
    ranges = source.ranges(spark, "n.p", fields)
    got = [r for n in range(ranges.count) for r in ranges.read(n, n).collect()]
    assert sorted((r.id, r.part) for r in got) == [(i, i % 3) for i in range(20)]


def test_catalog_names_each_table_once(spark):
    with pytest.raises(ValueError):
        catalog_frame(spark, [Stream("n.a"), Stream("n.a")])


def test_positions_of_streams_stay_apart(spark, world):
    """A commit of one stream passes over nothing of another whose positions are lower."""
    root, source, destination, store = world
    relation = dict(oid=1, table="n.a", columns=["id", "v"])
    land(
        frame(
            spark,
            [
                message(100, "R", "z", **relation), message(101, "B", "z"),
                message(102, "I", "z", oid=1, new=t("5", "z")), message(103, "C", "z"),
            ],
        ),
        f"{root}/in",
    )
    run(spark, world, from_earliest=True)
    saved = {r.stream_id: r.last_position for r in store.load(spark).streams.collect()}
    assert saved[f"{GLOBAL}/s"] == 4 and saved[f"{GLOBAL}/z"] == 103 and saved["n.a"] is None
    later_changes(spark, root)
    run(spark, world)
    assert operations(spark, destination, "a_log") == {"SNAPSHOT": 100, "INSERT": 2, "UPDATE": 1}


def test_global_position_of_several_streams_is_refused(spark, world):
    root, _, _, store = world
    land(frame(spark, [message(100, "B", "z"), message(101, "C", "z")]), f"{root}/in")
    row = [(GLOBAL, None, "0/4", 4, None, None, None, NOW)]
    store.update(spark, streams=small_frame(spark, row, STREAM_SCHEMA))
    with pytest.raises(ValueError):
        run(spark, world)


def test_states_are_kept(spark, world):
    """A loaded table's state through changes in later syncs: new, deleted and moved rows, values left unchanged, a TRUNCATE."""
    root, source, destination, store = world
    streams = [Stream("n.a", destination_table="a_log", primary_key=("id",)), Stream("n.b")]
    options = {"clock": clock, "states": f"{root}/states", "files_per_trigger": 1}

    def state():
        kept = CurrentTable(f"{root}/states/g=0/a_log", [Field("id", "INT64"), Field("v", "STRING")])
        return {r.id: r.v for r in kept.read(spark).collect()}

    sync(spark, source, f"{root}/in", destination, streams, store, **options)
    assert state() == {i: str(i) for i in range(100)}
    unchanged = [("t", "200"), ("u", None)]
    land(
        frame(
            spark,
            [
                message(5, "B"), message(6, "R", oid=1, table="n.a", columns=["id", "v"]), message(7, "I", oid=1, new=t("500", "new")),
                message(8, "U", oid=1, old=t("20") + [("n", None)], new=unchanged), message(9, "D", oid=1, old=t("3") + [("n", None)]),
                message(10, "U", oid=1, new=t("4", "late")), message(11, "C"),
            ],
        ),
        f"{root}/in",
    )
    sync(spark, source, f"{root}/in", destination, streams, store, **options)
    want = {i: str(i) for i in range(100) if i not in (3, 20)} | {4: "late", 200: "20", 500: "new"}
    assert state() == want
    land(frame(spark, [message(12, "B"), message(13, "T", oid=1), message(14, "I", oid=1, new=t("1", "again")), message(15, "C")]), f"{root}/in")
    sync(spark, source, f"{root}/in", destination, streams, store, **options)
    assert state() == {1: "again"}
    assert operations(spark, destination, "a_log") == {"SNAPSHOT": 100, "INSERT": 2, "UPDATE": 2, "DELETE": 1}
