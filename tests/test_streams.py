"""Streams into sinks: several batches, kills between steps, open transactions."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from changelake.functions.types import Field
from changelake.operators import changes as chg
from changelake.plans.config import Destination, Stream
from changelake.plans.progress_store import GLOBAL, ProgressStore
from changelake.plans.topic_log import only_stream
from changelake.sources.changelog import change_log_stream
from changelake.streaming.change_cdc import change_cdc
from changelake.streaming.topic_cdc import topic_cdc
from tests.test_changes import frame, message, t

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
MESSAGES = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
PAYLOAD = (Field("k", "INT64", nullable=False), Field("s", "STRING"))
ENTRY = Stream("events", "events", "cdc", True, PAYLOAD)


def clock():
    return NOW


class Killed(Exception):
    pass


def land(df, path):
    """One more file for the stream."""
    df.coalesce(1).write.mode("append").parquet(path)


def topic_messages(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 10 == 9, "broken").otherwise(
            F.concat(F.lit('{"k": '), "id", F.lit(', "s": "x"}'))
        ).alias("value"),
        F.lit("events").alias("topic"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
    )


def run_topic(spark, root, store, destination):
    stream = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1)
    topic_cdc(
        stream.parquet(f"{root}/in"), [ENTRY], destination, store, clock
    ).awaitTermination()


def check_topic(spark, destination, n):
    good = destination.read(spark, "events")
    assert sorted(r.k for r in good.collect()) == [i for i in range(n) if i % 10 != 9]
    rejects = destination.read(spark, "events__rejects")
    assert sorted(r._kafka_offset for r in rejects.collect()) == list(range(9, n, 10))
    assert {r._reject_reason for r in rejects.collect()} == {"k"}


def test_topic_batches(spark, tmp_path):
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    for n in range(3):
        land(topic_messages(spark, n * 40, n * 40 + 40), f"{root}/in")
    run_topic(spark, root, store, destination)
    check_topic(spark, destination, 120)
    land(topic_messages(spark, 120, 150), f"{root}/in")
    run_topic(spark, root, store, destination)
    check_topic(spark, destination, 150)
    saved = store.load(spark)
    assert sorted(tuple(r) for r in saved.offsets.collect()) == [
        ("events.events", "events", p, 147 + p) for p in range(3)
    ]
    assert saved.streams.filter("stream_id = 'events.events'").first().sync_mode == "cdc"
    row = destination.read(spark, "events").filter("_kafka_offset = 7").first()
    assert row._cdc_operation == "INSERT"
    assert row._kafka_timestamp_ms == 7000


@pytest.mark.parametrize("step", ["write_batch", "update"])
def test_topic_killed(spark, tmp_path, monkeypatch, step):
    """A batch that fails after its first write is repeated without loss or double rows."""
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    land(topic_messages(spark, 0, 40), f"{root}/in")
    land(topic_messages(spark, 40, 80), f"{root}/in")
    owner = Destination if step == "write_batch" else ProgressStore
    original, calls = getattr(owner, step), []

    def failing(self, *args, **kwargs):
        original(self, *args, **kwargs)
        calls.append(1)
        if len(calls) == 2:
            raise Killed()

    with monkeypatch.context() as m:
        m.setattr(owner, step, failing)
        with pytest.raises(Exception):
            run_topic(spark, root, store, destination)
    run_topic(spark, root, store, destination)
    check_topic(spark, destination, 80)


def test_topic_resumes_from_saved_offsets(spark, tmp_path):
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    saved = spark.createDataFrame(
        [("events.events", "events", 0, 30), ("other", "events", 1, 99)],
        "stream_id string, topic string, partition int, last_offset bigint",
    )
    store.update(spark, offsets=saved)
    land(topic_messages(spark, 0, 40), f"{root}/in")
    run_topic(spark, root, store, destination)
    got = sorted(r._kafka_offset for r in destination.read(spark, "events").collect())
    assert got == [i for i in range(40) if i % 10 != 9 and (i % 3 != 0 or i > 30)]


@pytest.mark.parametrize(
    "streams",
    [
        [],
        [ENTRY, ENTRY],
        [Stream("events", None, "cdc")],
        [Stream("events", " ", "cdc")],
        [Stream("events", "events", "full_load+cdc")],
    ],
)
def test_topic_catalog_is_checked(streams):
    with pytest.raises(ValueError):
        only_stream(streams)


# --- change streams --------------------------------------------------------------------------

TABLES = {
    "n.a": ("a_log", [Field("id", "INT64", False, True), Field("v", "STRING")]),
    "n.b": ("b_log", [Field("id", "INT64"), Field("extra", "DOUBLE")]),
}
FILES = [
    [
        message(0, "B", xid=1),
        message(1, "R", oid=1, table="n.a", columns=["id", "v"]),
        message(2, "I", oid=1, new=t("1", "one")),
        message(3, "C"),
        message(4, "B", xid=2),
        message(5, "R", oid=2, table="n.b", columns=["id", "extra"]),
        message(6, "I", oid=2, new=t("7", "0.5")),
    ],
    [  # nothing is committed here
        message(7, "U", oid=1, new=t("1", "uno")),
        message(8, "I", oid=2, new=t("8", "bad")),
    ],
    [
        message(9, "R", oid=1, table="n.a", columns=["v", "id"]),
        message(10, "I", oid=1, new=t("two", "2")),
        message(11, "C"),
        message(12, "B", xid=3),
        message(13, "D", oid=1, old=t("two", "2")),
        message(14, "I", oid=9, new=t("x")),
    ],
    [message(15, "C"), message(16, "B", xid=4), message(17, "I", oid=1, new=t("open", "3"))],
]
A_ROWS = [(2, "INSERT", 1, "one"), (7, "UPDATE", 1, "uno"), (10, "INSERT", 2, "two"),
          (13, "DELETE", 2, "two")]
B_ROWS = [(6, "INSERT", 7, 0.5), (8, "INSERT", 8, None)]


def run_changes(spark, root, store, destination, files=1, **options):
    stream = change_log_stream(spark, f"{root}/in", files)
    change_cdc(stream, TABLES, destination, store, clock=clock, **options).awaitTermination()


def change_rows(spark, destination, table, *columns):
    rows = destination.read(spark, table).select("_cdc_position", "_cdc_operation", *columns)
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("files,kind", [(1, "parquet"), (10, "table")])
def test_change_stream(spark, tmp_path, files, kind):
    root = str(tmp_path)
    store = ProgressStore(f"{root}/state")
    destination = Destination(
        type=kind, base_path=f"{root}/out", table_namespace=f"n{uuid.uuid4().hex}"
    )
    for rows in FILES:
        land(frame(spark, rows), f"{root}/in")
    run_changes(spark, root, store, destination, files)
    assert change_rows(spark, destination, "a_log", "id", "v") == A_ROWS
    assert change_rows(spark, destination, "b_log", "id", "extra") == B_ROWS
    saved = {r.stream_id: r.last_position for r in store.load(spark).streams.collect()}
    assert saved == {"n.a": 15, "n.b": 15, GLOBAL: 15}
    land(frame(spark, [message(18, "C")]), f"{root}/in")
    run_changes(spark, root, store, destination, files)
    assert change_rows(spark, destination, "a_log", "id", "v") == [*A_ROWS, (17, "INSERT", 3, "open")]


def test_open_transaction_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    for rows in FILES[:2]:
        land(frame(spark, rows), f"{root}/in")
    run_changes(spark, root, store, destination)
    assert change_rows(spark, destination, "a_log", "id", "v") == A_ROWS[:1]
    with pytest.raises(Exception):
        destination.read(spark, "b_log")


@pytest.mark.parametrize("fail_at", [2, 3])
def test_change_stream_killed(spark, tmp_path, monkeypatch, fail_at):
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    for rows in FILES:
        land(frame(spark, rows), f"{root}/in")
    original, calls = Destination.write_batch, []

    def failing(self, *args):
        original(self, *args)
        calls.append(1)
        if len(calls) == fail_at:
            raise Killed()

    with monkeypatch.context() as m:
        m.setattr(Destination, "write_batch", failing)
        with pytest.raises(Exception):
            run_changes(spark, root, store, destination)
    run_changes(spark, root, store, destination)
    assert change_rows(spark, destination, "a_log", "id", "v") == A_ROWS
    assert change_rows(spark, destination, "b_log", "id", "extra") == B_ROWS


def test_start_position(spark, tmp_path):
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    for rows in FILES:
        land(frame(spark, rows), f"{root}/in")
    run_changes(spark, root, store, destination, start_positions={"s": 11, "other": 99})
    assert change_rows(spark, destination, "a_log", "id", "v") == A_ROWS[3:]


def test_streams_commit_apart(spark, tmp_path):
    """The open transaction of one stream does not hold back another."""
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")

    def both(*messages):
        land(frame(spark, list(messages)), f"{root}/in")

    relation = dict(oid=1, table="n.a", columns=["id", "v"])
    both(
        message(0, "R", "s", **relation), message(0, "R", "z", **relation),
        message(1, "B", "s"), message(2, "I", "s", oid=1, new=t("1", "s")),
        message(1, "B", "z"), message(2, "I", "z", oid=1, new=t("2", "z")), message(3, "C", "z"),
    )
    both(message(4, "B", "z"), message(5, "I", "z", oid=1, new=t("3", "z")), message(6, "C", "z"))
    run_changes(spark, root, store, destination)
    assert [r[2:] for r in change_rows(spark, destination, "a_log", "id", "v")] == [(2, "z"), (3, "z")]
    both(message(3, "C", "s"))
    run_changes(spark, root, store, destination)
    got = [r[2:] for r in change_rows(spark, destination, "a_log", "id", "v")]
    assert sorted(got) == [(1, "s"), (2, "z"), (3, "z")]


def test_repeated_messages_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    for rows in (FILES[0], FILES[1], FILES[2], FILES[0][1:3] + FILES[3]):
        land(frame(spark, rows), f"{root}/in")
    run_changes(spark, root, store, destination)
    assert change_rows(spark, destination, "a_log", "id", "v") == A_ROWS


@pytest.mark.parametrize("order", [(3, 2, 1, 0), (2, 0, 3, 1), (1, 3, 0, 2)])
def test_files_in_any_order(spark, tmp_path, order):
    """Parts of transactions that come late are applied all the same, and once."""
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    for n in (*order, order[1], order[2]):
        land(frame(spark, FILES[n]), f"{root}/in")
        run_changes(spark, root, store, destination)
    assert change_rows(spark, destination, "a_log", "id", "v") == A_ROWS
    assert change_rows(spark, destination, "b_log", "id", "extra") == B_ROWS


@pytest.mark.parametrize("first,xids,late_last", [("0/50", False, True), ("0/50", False, False), (None, True, True)])
def test_late_commit_and_next_begin(spark, tmp_path, first, xids, late_last):
    """Rows of two transactions aren't taken as one while the COMMIT and the BEGIN between them are to come."""
    root = str(tmp_path)
    store, destination = ProgressStore(f"{root}/state"), Destination(base_path=f"{root}/out")
    second = "0/60" if first else None
    around = [
        message(1, "B", xid=1, lsn=first), message(2, "R", oid=1, table="n.a", columns=["id", "v"]),
        message(3, "I", oid=1, new=t("1", "one")),
        message(6, "I", oid=1, new=t("2", "two")), message(7, "C", xid=2 if xids else None, lsn=second),
    ]
    between = [message(4, "C", xid=1 if xids else None, lsn=first), message(5, "B", xid=2, lsn=second)]
    for n, rows in enumerate([around, between] if late_last else [between, around]):
        land(frame(spark, rows), f"{root}/in")
        run_changes(spark, root, store, destination, start_positions={"s": 0x50 if first else 4})
        if late_last and n == 0:
            with pytest.raises(Exception):
                destination.read(spark, "a_log")
    # The load has the first transaction.
    assert change_rows(spark, destination, "a_log", "id", "v") == [(6, "INSERT", 2, "two")]


def test_sample_stream(spark, tmp_path):
    from changelake.sources.topics import sample_stream

    query = (
        sample_stream(spark, 50).writeStream.format("memory").queryName("sampled")
        .option("checkpointLocation", str(tmp_path)).start()
    )
    try:
        for _ in range(20):
            query.processAllAvailable()
            if spark.table("sampled").count():
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    row = spark.table("sampled").orderBy("key").first()
    assert row.key == "1001" and '"seq":1,' in row.value


def test_schema_of_messages():
    assert chg.MESSAGE_SCHEMA.fieldNames()[:4] == ["stream_id", "seq", "lsn", "msg_type"]
