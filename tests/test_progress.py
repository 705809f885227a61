import datetime as dt
import json

from changelake.operators import progress as prg
from changelake.operators.catalog import sync_plan
from changelake.plans.config import Stream, catalog_frame
from changelake.plans.progress_store import GLOBAL, Progress, ProgressStore, read_state_json
from changelake.sinks import folders

NOW = dt.datetime(2024, 6, 1)
OFFSETS = "stream_id string, topic string, partition int, last_offset bigint"


def streams(spark, *rows):
    return spark.createDataFrame(rows, prg.STREAM_SCHEMA)


def offsets(spark, *rows):
    return spark.createDataFrame(rows, OFFSETS)


def test_store(spark, tmp_path):
    store = ProgressStore(str(tmp_path / "p"))
    assert store.load(spark).streams.count() == 0
    row = ("n.t", "cdc", "0/5", 5, None, None, None, NOW)
    store.update(spark, streams=streams(spark, row))
    store.update(spark, offsets=offsets(spark, ("s", "t", 0, 7)))
    store.update(spark, offsets=offsets(spark, ("s", "t", 1, 3), ("s", "t", 0, 2)))
    saved = store.load(spark)
    assert [tuple(r)[:4] for r in saved.streams.collect()] == [("n.t", "cdc", "0/5", 5)]
    assert sorted(tuple(r) for r in saved.offsets.collect()) == [("s", "t", 0, 7), ("s", "t", 1, 3)]


def test_unfinished_version_does_not_count(spark, tmp_path):
    store = ProgressStore(str(tmp_path / "p"))
    store.update(spark, offsets=offsets(spark, ("s", "t", 0, 7)))
    at = f"{store.folder(spark)}/v=1"
    offsets(spark, ("s", "t", 0, 99)).write.parquet(f"{at}/offsets")  # killed before the marker
    assert store.load(spark).offsets.first().last_offset == 7
    store.update(spark, offsets=offsets(spark, ("s", "t", 0, 8)))
    assert store.load(spark).offsets.first().last_offset == 8


def test_old_versions_go(spark, tmp_path):
    store = ProgressStore(str(tmp_path / "p"))
    for n in range(8):
        store.update(spark, offsets=offsets(spark, ("s", "t", 0, n)))
    assert len(folders.numbered(spark, store.folder(spark), "v=")) == 5
    assert store.load(spark).offsets.first().last_offset == 7


def test_full_refresh(spark, tmp_path):
    store = ProgressStore(str(tmp_path / "p"))
    store.update(spark, offsets=offsets(spark, ("s", "t", 0, 7)))
    store.reset(spark)
    assert store.generation(spark) == 1
    assert store.load(spark).offsets.count() == 0
    assert store.start_offsets(spark).count() == 0


def test_start_offsets_stay(spark, tmp_path):
    store = ProgressStore(str(tmp_path / "p"))
    store.update(spark, offsets=offsets(spark, ("s", "t", 0, 7)))
    assert store.start_offsets(spark).first().last_offset == 7
    store.update(spark, offsets=offsets(spark, ("s", "t", 0, 50)))
    assert store.start_offsets(spark).first().last_offset == 7


def test_merge_streams(spark):
    later = dt.datetime(2024, 7, 1)
    old = streams(
        spark,
        ("a", "full_load", "0/9", 9, True, 3, 3, NOW),
        ("b", "full_load", "0/9", 9, False, 1, 3, later),
    )
    new = spark.createDataFrame(
        [("a", "cdc", 5, "0/5", NOW), ("b", "cdc", 12, "0/C", NOW), ("c", "cdc", 1, "0/1", NOW)],
        "stream_id string, sync_mode string, last_position bigint, last_lsn string, "
        "last_sync_time timestamp",
    )
    got = sorted(tuple(r) for r in prg.merge_streams(old, new).collect())
    assert got == [
        ("a", "cdc", "0/9", 9, True, 3, 3, NOW),
        ("b", "cdc", "0/C", 12, False, 1, 3, later),
        ("c", "cdc", "0/1", 1, None, None, None, NOW),
    ]


def test_starting_offsets(spark):
    saved = offsets(spark, ("s", "t", 1, 9), ("s", "t", 0, 4), ("s", "u", 0, 1))
    text = prg.starting_offsets(saved, "t").first()[0]
    assert json.loads(text) == {"t": {"0": 5, "1": 10}}
    text = prg.starting_offsets(saved, "t", 4, -2).first()[0]
    assert json.loads(text) == {"t": {"0": 5, "1": 10, "2": -2, "3": -2}}
    assert prg.starting_offsets(saved, "x", 4).first() is None


def test_state_json(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text(json.dumps({
        "streams": {
            "topic.events": {
                "sync_mode": "cdc", "last_lsn": None, "full_load_completed": False,
                "full_load_chunks_done": 0, "full_load_chunks_total": 0,
                "last_sync_time": "2025-03-04T05:06:07.891234567Z",
                "kafka_offsets": {"topic": {"0": 41, "3": 7}},
            },
            "public.t": {"sync_mode": "cdc", "last_lsn": "1/2", "full_load_completed": True},
        },
        "global_lsn": "1/2",
    }, indent=2))
    progress = read_state_json(spark, str(path))
    assert sorted(tuple(r) for r in progress.offsets.collect()) == [
        ("topic.events", "topic", 0, 41), ("topic.events", "topic", 3, 7),
    ]
    got = {r.stream_id: (r.last_position, r.full_load_completed) for r in progress.streams.collect()}
    assert got == {
        "topic.events": (None, False), "public.t": (4294967298, True), GLOBAL: (4294967298, None),
    }
    store = ProgressStore(str(tmp_path / "p"))
    store.save(spark, Progress(*progress))
    assert store.load(spark).offsets.count() == 2


def test_sync_plan(spark):
    catalog = catalog_frame(
        spark,
        [
            Stream("n.full", sync_mode="Full_Load"),
            Stream("n.done", sync_mode="full_load+cdc"),
            Stream("n.a.b", sync_mode="odd"),
            Stream("plain", sync_mode="CDC", destination_table=""),
            Stream("n.named", destination_table="x"),
        ],
    )
    saved = spark.createDataFrame(
        [("n.done", True), ("n.named", False), ("other", True)],
        "stream_id string, full_load_completed boolean",
    )
    got = {tuple(r) for r in sync_plan(catalog, saved).collect()}
    assert got == {
        ("n.full", "full_load", True, False, "full"),
        ("n.done", "full_load+cdc", False, True, "done"),
        ("n.a.b", "full_load+cdc", True, True, "a.b"),
        ("plain", "cdc", False, True, "plain"),
        ("n.named", "full_load+cdc", True, True, "x"),
    }
    assert Stream("n.a.b").destination == "a.b"
    assert Stream("plain", destination_table="").destination == "plain"
