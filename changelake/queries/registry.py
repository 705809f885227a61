"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions.casts import cast_columns, conform
from changelake.functions.positions import format_lsn, parse_lsn
from changelake.functions.types import Field, destination_schema, resolve_type, topic_fields
from changelake.operators import catalog as cat
from changelake.operators import changes as chg
from changelake.operators import progress as prg
from changelake.operators import records as rec
from changelake.operators import state as sta
from changelake.operators import versions as ver
from changelake.operators.transactions import assemble_transactions, commit_positions, stream_positions
from changelake.plans.change_log import committed_changes, table_changes
from changelake.plans.config import Destination, Stream
from changelake.plans.current_table import CurrentTable
from changelake.plans.full_load import full_load
from changelake.plans.increment import read_increment
from changelake.plans.progress_store import ProgressStore, malformed
from changelake.plans.sync import sync, sync_topic
from changelake.plans.topic_log import topic_log
from changelake.queries import inputs
from changelake.session import shared_folder, small_frame
from changelake.sinks.parquet import append_parquet, write_batch
from changelake.sinks.tables import append_table
from changelake.sinks.topics import publish_frame
from changelake.sources import snapshot as snap
from changelake.sources.changelog import change_log_stream
from changelake.sources.tables import FileTables, Ranges
from changelake.sources.topics import sample_events, text_messages, topic_envelope
from changelake.streaming.change_cdc import change_cdc

QUERIES = {}

# Width of the key ranges of `orders` and `lineitem` in the snapshot queries.
ORDER_RANGE = 5000

# Messages of a landed file, about.
FILE_MESSAGES = 262_144

ORDERS_A = [Field("o_orderkey", "INT64"), Field("o_custkey", "INT64"), Field("o_orderstatus")]


def query(fn):
    QUERIES["q_" + fn.__name__.rstrip("_")] = fn
    return fn


def as_micros(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as microseconds, so that both engines print them alike."""
    return df.withColumns({n: F.unix_micros(n) for n in names})


def entries_text(column: str) -> Column:
    """A map as text, entries in order of name."""
    sorted_entries = F.array_sort(F.map_entries(column))
    return F.array_join(
        F.transform(
            sorted_entries,
            lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("<null>"))),
        ),
        ",",
    )


# --- sources ---------------------------------------------------------------------------------


@query
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    rows = snap.snapshot_scan(inputs.table(spark, sf_dir, "orders"), columns, inputs.ingest_ts())
    return as_micros(rows, "_cdc_timestamp")


@query
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pages(name: str, key: str, rows: int, empty: int) -> DataFrame:
        last = F.expr(f"max({key}) div {rows}L") + (1 - empty)
        return inputs.table(spark, sf_dir, name).agg(last.alias("pages")).select(
            F.lit(name).alias("table_name"), F.col("pages").cast("bigint").alias("pages")
        )

    tables = (
        pages("orders", "o_orderkey", 10, 0)
        .unionByName(pages("lineitem", "l_orderkey", 2, 0))
        .unionByName(pages("events", "event_id", 4, 0))
        .unionByName(pages("region", "r_regionkey", 1000, 1))
    )
    return snap.chunk_plan(tables)


@query
def chunked_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    chunks = snap.key_chunks(orders, "o_orderkey", ORDER_RANGE)
    return snap.chunked_snapshot(orders, chunks)


@query
def snapshot_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    chunks = snap.key_chunks(orders, "o_orderkey", ORDER_RANGE)
    rest = snap.snapshot_resume(orders, chunks, chunks.count // 3)
    return snap.chunked_snapshot(rest, chunks)


@query
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_envelope(inputs.topic(spark, sf_dir))


@query
def sample_events_(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    numbers = events.select((F.col("event_id") + 1).alias("i"), "ts")
    return sample_events(numbers, F.col("ts"))


@query
def publish_frame_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_frame(inputs.topic(spark, sf_dir), "events")


# --- catalog ---------------------------------------------------------------------------------


def _discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.discover(
        inputs.information_columns(spark, sf_dir),
        inputs.table_constraints(spark, sf_dir),
        inputs.key_column_usage(spark, sf_dir),
        ["public"],
    )


@query
def discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _discovered(spark, sf_dir)


@query
def discover_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_type") == "error", "__consumer_offsets").otherwise(
        F.concat_ws(".", F.lit("shop"), "event_type", F.col("user_id").cast("string"))
    )
    return cat.discover_topics(inputs.table(spark, sf_dir, "events").select(name.alias("topic")))


@query
def resolve_type_(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = inputs.information_columns(spark, sf_dir)
    name = F.when(F.col("is_nullable") == "NO", F.col("data_type")).otherwise(
        F.nullif("data_type", F.lit("inet"))
    )
    return columns.select("table_name", "column_name", resolve_type(name).alias("type"))


@query
def stream_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    streams = orders.select(
        F.concat(F.lit("public.t_"), F.col("o_orderkey").cast("string")).alias("table")
    )
    return cat.stream_select(_discovered(spark, sf_dir), streams).select(
        "table_name", "column_name", "type"
    )


@query
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.sync_plan(
        inputs.catalog(spark, sf_dir), inputs.catalog_progress(spark, sf_dir)
    )


# --- change messages -------------------------------------------------------------------------


@query
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chg.classify_messages(inputs.changes(spark, sf_dir))
    return log.select("seq", "msg_type", "message", "yields_row")


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chg.resolve_relation(inputs.changes(spark, sf_dir))


@query
def resolve_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).select(
        "seq", "rel_oid", "table_name", F.array_join("rel_columns", ",").alias("rel_columns")
    )


@query
def resolve_many_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `resolve_relation`, with about a third as many announcements as changes."""
    return chg.resolve_relation(inputs.many_relations(spark, sf_dir)).select(
        "seq", "rel_oid", "table_name", F.array_join("rel_columns", ",").alias("rel_columns")
    )


@query
def tuple_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.coalesce("new_tuple", "old_tuple")
    named = chg.tuple_to_columns(values, F.col("rel_columns"))
    return _resolved(spark, sf_dir).select("seq", F.explode(named).alias("name", "value"))


@query
def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = chg.before_after(_resolved(spark, sf_dir))
    return images.select(
        "seq",
        "msg_type",
        entries_text("after").alias("after"),
        entries_text("before").alias("before"),
    )


@query
def row_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = chg.row_image(chg.before_after(_resolved(spark, sf_dir)))
    return images.select("seq", "msg_type", entries_text("image").alias("image"))


@query
def target_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = chg.target_filter(_resolved(spark, sf_dir), inputs.targets(spark, sf_dir))
    return kept.select("seq", "table_name")


@query
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    committed = assemble_transactions(inputs.changes(spark, sf_dir))
    return committed.select(
        "seq", "msg_type", "tx_xid", "commit_seq",
        parse_lsn(F.col("commit_lsn")).alias("commit_position"),
    )


@query
def lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    texts = orders.select("o_orderkey", inputs.lsn_text(F.col("o_orderkey")).alias("lsn"))
    position = parse_lsn(F.col("lsn"))
    return texts.select(
        "o_orderkey", "lsn", position.alias("position"), format_lsn(position).alias("again")
    )


# --- records ---------------------------------------------------------------------------------


@query
def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = topic_fields(inputs.PAYLOAD, True)
    return rec.normalize_payload(topic_envelope(inputs.topic(spark, sf_dir)), fields)


@query
def normalize_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = topic_fields(inputs.PAYLOAD, True)
    rows = rec.normalize_payload(topic_envelope(inputs.dirty_topic(spark, sf_dir)), fields)
    return rows.select("_kafka_offset", "_payload", "k")


CAST_FIELDS = [
    Field("i32", "INT32"), Field("i64", "INT64"), Field("f32", "FLOAT"), Field("f64", "DOUBLE"),
    Field("flag", "BOOLEAN"), Field("name", "STRING"), Field("raw", "BYTES"),
    Field("day", "DATE"), Field("clock", "TIME"), Field("at", "TIMESTAMP"),
    Field("at_tz", "TIMESTAMP_TZ"), Field("price", "DECIMAL"), Field("doc", "JSON"),
    Field("id", "UUID"), Field("list", "ARRAY"),
]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order columns as text, with values that do not fit for some keys."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    text = key.cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    hour = F.lpad((key % 24).cast("string"), 2, "0")
    minute = F.lpad((key % 60).cast("string"), 2, "0")
    clock = F.concat(hour, F.lit(":"), minute, F.lit(":09.25"))
    return inputs.table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 5 == 1, "x1").when(key % 5 == 2, F.concat(text, F.lit(".7")))
        .when(key % 5 == 3, "99999999999").otherwise(text).alias("i32"),
        F.when(key % 4 == 3, F.concat(F.lit("-"), text, F.lit(".2"))).otherwise(text).alias("i64"),
        F.when(key % 3 == 2, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("f32"),
        F.when(key % 3 == 1, "1,5").otherwise(F.col("o_totalprice").cast("string")).alias("f64"),
        F.when(status == "O", "t").when(status == "F", "TRUE").when(key % 2 == 0, "f")
        .alias("flag"),
        F.col("o_orderpriority").alias("name"),
        F.when(key % 3 == 0, F.concat(F.lit("\\x"), F.hex(key + 4096))).otherwise(text)
        .alias("raw"),
        F.when(key % 6 == 5, "2024-13-01").otherwise(day).alias("day"),
        F.when(key % 7 == 6, "25:00:00").otherwise(clock).alias("clock"),
        F.concat(day, F.when(key % 2 == 0, "T").otherwise(" "), clock).alias("at"),
        F.when(key % 3 == 0, F.concat(day, F.lit("T"), clock, F.lit("Z")))
        .when(key % 3 == 1, F.concat(day, F.lit(" "), clock, F.lit("+00")))
        .otherwise(F.concat(day, F.lit(" "), clock, F.lit("+02:00"))).alias("at_tz"),
        F.when(key % 9 == 8, "12x").otherwise(F.concat(text, F.lit("."), minute)).alias("price"),
        F.concat(F.lit('{"a": '), text, F.lit("}")).alias("doc"),
        F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(text, 12, "0")).alias("id"),
        F.when(key % 4 == 0, F.concat(F.lit('["'), text, F.lit('","b"]')))
        .when(key % 4 == 1, F.concat(F.lit("{"), text, F.lit(",b}")))
        .when(key % 4 == 2, F.concat(F.lit('{"'), text, F.lit('","b"}')))
        .otherwise(text).alias("list"),
    )


@query
def cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cast_columns(_texts(spark, sf_dir), CAST_FIELDS)
    return typed.withColumns(
        {
            "raw": F.hex("raw"),
            "day": F.date_format("day", "yyyy-MM-dd"),
            "at": F.unix_micros(F.col("at").cast("timestamp")),
            "at_tz": F.unix_micros("at_tz"),
            "price": F.expr("format_number(price, '0.000000000000000000')"),
            "f32": F.col("f32").cast("double"),
            "list": F.array_join("list", "|"),
        }
    )


@query
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [
        Field("o_custkey", "INT64"), Field("missing", "STRING"), Field("o_orderkey", "INT64"),
    ]
    return rec.project_to_schema(inputs.table(spark, sf_dir, "orders"), wanted)


@query
def project_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = chg.row_image(chg.before_after(_resolved(spark, sf_dir)))
    return images.select("seq", *rec.project_image(F.col("image"), ORDERS_A))


@query
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _resolved(spark, sf_dir).select("seq", "msg_type", "ts")
    tagged = rec.add_cdc_metadata(changes, rec.change_operation(), F.col("ts"))
    return as_micros(tagged.drop("ts", "msg_type"), "_cdc_timestamp")


@query
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = topic_envelope(inputs.topic(spark, sf_dir))
    ms = F.when(F.col("_kafka_offset") % 3 != 0, F.col("_kafka_timestamp_ms")).otherwise(
        F.when(F.col("_kafka_offset") % 2 == 0, 0)
    )
    time = rec.event_time(ms, inputs.ingest_ts())
    return messages.select("_kafka_offset", F.unix_micros(time).alias("event_us"))


@query
def required(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = topic_fields([Field("k", "INT64", nullable=False)], True)
    rows = topic_log(inputs.dirty_topic(spark, sf_dir), fields, inputs.ingest_ts())
    good, rejected = rec.split_rejects(rows)
    both = good.unionByName(rejected, allowMissingColumns=True)
    return both.select("_kafka_offset", "k", F.col("_reject_reason").alias("reject_reason"))


# --- progress --------------------------------------------------------------------------------


@query
def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prg.offset_watermark(inputs.topic(spark, sf_dir))


@query
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = small_frame(
        spark,
        [("events", 0, 100), ("events", 1, 100)],
        "topic string, partition int, last_offset bigint",
    )
    rest = prg.resume_filter(inputs.topic(spark, sf_dir), saved)
    return rest.select("partition", "offset", "value")


@query
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = prg.checkpoint_batches(inputs.topic(spark, sf_dir), 1000)
    return cut.groupBy("partition", "batch").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query
def merge_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of one partition per customer, brought forward by one per user."""
    saved = inputs.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("last_offset")
    )
    seen = inputs.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max("event_id").alias("last_offset")
    )

    def frame(df: DataFrame, key: str) -> DataFrame:
        return df.select(
            F.lit("s").alias("stream_id"), F.lit("t").alias("topic"),
            F.col(key).cast("int").alias("partition"), "last_offset",
        )

    return prg.merge_offsets(frame(saved, "o_custkey"), frame(seen, "user_id"))


@query
def merge_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of customers, updated by the users seen in the events."""
    orders = inputs.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("last_position"),
        F.max(F.col("o_orderdate").cast("timestamp")).alias("last_sync_time"),
        F.bool_and(F.col("o_orderstatus") != "P").alias("full_load_completed"),
        F.count(F.lit(1)).cast("int").alias("full_load_chunks_done"),
    )
    saved = orders.select(
        F.concat(F.lit("u_"), F.col("o_custkey").cast("string")).alias("stream_id"),
        F.lit("full_load").alias("sync_mode"),
        format_lsn(F.col("last_position")).alias("last_lsn"),
        "last_position",
        "full_load_completed",
        "full_load_chunks_done",
        F.lit(None).cast("int").alias("full_load_chunks_total"),
        "last_sync_time",
    )
    events = inputs.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max("event_id").alias("last_position"),
        F.max(F.col("ts").cast("timestamp")).alias("last_sync_time"),
    )
    update = events.select(
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("stream_id"),
        F.lit("cdc").alias("sync_mode"),
        format_lsn(F.col("last_position")).alias("last_lsn"),
        "last_position",
        "last_sync_time",
    )
    return as_micros(prg.merge_streams(saved, update), "last_sync_time").drop(
        "full_load_chunks_total"
    )


@query
def commit_positions_(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _resolved(spark, sf_dir).select("table_name").distinct()
    return commit_positions(inputs.changes(spark, sf_dir), tables)


@query
def load_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey")
    pages = orders.agg((F.expr("max(o_orderkey) div 10L") + 1).alias("pages"))
    plan = snap.chunk_plan(pages.withColumn("table_name", F.lit("orders")), 100)
    high = orders.agg(F.max("o_orderkey")).first()[0]
    chunks = snap.Chunks("o_orderkey", 0, 1000, high // 1000 + 1)
    rows = snap.chunked_snapshot(orders, chunks).withColumn("table_name", F.lit("orders"))
    return prg.load_progress(rows, plan)


@query
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _resolved(spark, sf_dir)
    return prg.sync_counts(
        rec.add_cdc_metadata(changes, rec.change_operation(), inputs.ingest_ts())
    )


# --- jobs ------------------------------------------------------------------------------------


@query
def topic_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic as a typed change log: envelope, payload, time, operation, required columns."""
    fields = topic_fields([Field("k", "INT64", nullable=False)], True)
    rows = topic_log(inputs.topic(spark, sf_dir), fields, inputs.ingest_ts())
    good, _ = rec.split_rejects(rows)
    return as_micros(good, "_cdc_timestamp")


@query
def table_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change stream as the typed change log of one table."""
    changes = committed_changes(
        inputs.changes(spark, sf_dir), inputs.targets(spark, sf_dir), inputs.ingest_ts()
    )
    good, _ = rec.split_rejects(table_changes(changes, "shop.orders_a", ORDERS_A))
    return as_micros(good, "_cdc_timestamp")


def _clock():
    return inputs.INGEST_TS


def _files(log: DataFrame, least: int) -> int:
    """How many files messages land in, so that none holds more than about FILE_MESSAGES."""
    return max(least, -(-log.count() // FILE_MESSAGES))


@query
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot appended to a dated folder in bounded files, read back."""
    root = shared_folder(spark, "append")
    rows = snapshot(spark, sf_dir)
    append_parquet(rows, root, "orders", inputs.INGEST_TS.date(), max_records=5000)
    back = spark.read.parquet(f"{root}/orders").drop("batch_id")
    return back.withColumn("ingest_date", F.date_format("ingest_date", "yyyy-MM-dd"))


@query
def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second written twice as after a kill, read back."""
    root = shared_folder(spark, "replay")
    rows = topic_change_log(spark, sf_dir).select("_kafka_partition", "_kafka_offset", "k")
    low = F.col("_kafka_partition") < 2
    day = inputs.INGEST_TS.date()
    for batch_id, part in (("b1", low), ("b2", ~low), ("b2", ~low)):
        write_batch(rows.filter(part), root, "events", batch_id, day)
    return spark.read.parquet(f"{root}/events").drop("ingest_date")


@query
def topic_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic job as a stream over the events file, read back from its sink."""
    return _topic_synced(spark, sf_dir, 1)


def _topic_synced(spark: SparkSession, sf_dir: str, runs: int) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    messages = stream.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    root = shared_folder(spark, "topic-sync")
    entry = Stream("events", "events", "cdc", True, tuple(inputs.PAYLOAD))
    destination = Destination(base_path=f"{root}/out")
    store = ProgressStore(f"{root}/state")
    for n in range(runs):
        sync_topic(spark, messages, destination, [entry], store, full_refresh=n > 0, clock=_clock)
    rows = destination.read(spark, "events").drop("batch_id")
    return as_micros(rows, "_cdc_timestamp").withColumn(
        "ingest_date", F.date_format("ingest_date", "yyyy-MM-dd")
    )


@query
def table_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table job: load `orders`, then stream landed changes of it."""
    orders = inputs.table(spark, sf_dir, "orders")
    root = shared_folder(spark, "table-sync")
    # Eight files, or as many as keep each small, that land in no order.
    log = inputs.changes(spark, sf_dir)
    log.repartition(_files(log, 8), F.expr("seq div 1024")).write.parquet(f"{root}/messages")
    path = f"{sf_dir}/orders.parquet"
    source = FileTables({"shop.orders_a": path}, {"shop.orders_a": "o_orderkey"})
    destination = Destination(base_path=f"{root}/out")
    sync(
        spark, source, f"{root}/messages", destination, [Stream("shop.orders_a")],
        ProgressStore(f"{root}/state"), clock=_clock, from_earliest=True,
    )
    rows = destination.read(spark, "orders_a").select(
        *orders.columns, "_cdc_position", "_cdc_operation"
    )
    return rows.withColumn(
        "o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    )


@query
def text_messages_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the topic source gives them, key and value in bytes."""
    raw = inputs.topic(spark, sf_dir).withColumns({c: F.col(c).cast("binary") for c in ("key", "value")})
    return as_micros(text_messages(raw), "timestamp")


@query
def destination_schema_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in the schema of its destination."""
    fields = [*ORDERS_A, Field("o_totalprice", "DOUBLE")]
    rows = conform(inputs.table(spark, sf_dir, "orders"), fields)
    rows = rec.add_cdc_metadata(rows, F.lit("SNAPSHOT"), inputs.ingest_ts())
    return as_micros(rows.to(destination_schema(fields)), "_cdc_timestamp")


@query
def append_table_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended to a catalog table, the second with a column more."""
    namespace = f"append_{uuid.uuid4().hex}"
    spark.sql(f"CREATE NAMESPACE {namespace} LOCATION '{shared_folder(spark, namespace)}'")
    orders = inputs.table(spark, sf_dir, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    append_table(orders.filter(~odd).select("o_orderkey", "o_totalprice"), f"{namespace}.orders")
    append_table(orders.filter(odd).select("o_orderstatus", "o_orderkey", "o_totalprice"), f"{namespace}.orders")
    return spark.table(f"{namespace}.orders")


class _Stopping:
    """A source that fails from its fifth range on."""

    def __init__(self, source: FileTables):
        self.source = source

    def ranges(self, *args) -> Ranges:
        found = self.source.ranges(*args)

        def read(first: int, last: int) -> DataFrame:
            if first >= 4:
                raise InterruptedError("stopped")
            return found.read(first, last)

        return Ranges(found.count, read)


@query
def load_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load in ranges that stops half way and is taken up again."""
    root = shared_folder(spark, "load-resumed")
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.repartition(8, "o_orderkey").write.parquet(f"{root}/orders")
    source = FileTables({"shop.orders": f"{root}/orders"}, {"shop.orders": "o_orderkey"})
    destination, store = Destination(base_path=f"{root}/out"), ProgressStore(f"{root}/state")
    load = ("shop.orders", ORDERS_A, destination, "orders", store, inputs.INGEST_TS, 2)
    try:
        full_load(spark, _Stopping(source), *load)
    except InterruptedError:
        full_load(spark, source, *load)
    return destination.read(spark, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "_cdc_operation")


@query
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic job, and once more from the start after a full refresh: every message twice."""
    return _topic_synced(spark, sf_dir, 2)


@query
def route_late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of three tables, one with rejects, whose files land last part first, a batch for each."""
    root = shared_folder(spark, "route")
    log = _landed(inputs.changes(spark, sf_dir), "route-log")
    # Parts that cut transactions: the second has the row changes alone.
    part = F.when(~F.col("msg_type").isin("B", "C", "R"), 2).when(F.col("seq") % 8 < 4, 1).otherwise(3)
    part = F.when(F.col("msg_type") == "R", 1).otherwise(part)
    files = _files(log, 4)
    for n in (3, 2, 1):
        log.filter(part == n).repartition(files, F.expr("seq div 1024")).write.mode("append").parquet(f"{root}/messages")
    destination = Destination(base_path=f"{root}/out")
    tables = {
        "shop.orders_a": ("a", ORDERS_A[:1]),
        "shop.orders_b": ("b", [ORDERS_A[0], Field("o_custkey", "INT64", nullable=False)]),
        "unknown.16386": ("c", [Field("col_0", "INT64")]),
    }
    change_cdc(
        change_log_stream(spark, f"{root}/messages", files), tables, destination, ProgressStore(f"{root}/state"), clock=_clock
    ).awaitTermination()

    def read(name: str, key: str) -> DataFrame:
        rows = destination.read(spark, name)
        return rows.select(F.lit(name).alias("name"), F.col(key).alias("key"), "_cdc_position", "_cdc_operation")

    found = read("a", "o_orderkey").unionByName(read("b", "o_orderkey")).unionByName(read("c", "col_0"))
    return found.unionByName(read("b__rejects", "o_orderkey"))


# --- state of tables -------------------------------------------------------------------------


def _landed(df: DataFrame, name: str) -> DataFrame:
    """The same rows, landed in the shared folder."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _account_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _landed(inputs.account_changes(spark, sf_dir), "state-messages")
    changes = committed_changes(log, ["shop.accounts"], inputs.ingest_ts(), truncates=True)
    return _landed(sta.table_events(changes, inputs.ACCOUNTS, ["id"]), "state-events")


def _account_rows(rows: DataFrame, position: str) -> DataFrame:
    return rows.select("id", "status", F.col("price").cast("double").alias("price"), "note", F.col(position).alias("position"))


@query
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each key of a table with deletions, changes of key, unchanged values and a TRUNCATE."""
    return _account_rows(sta.current_state(_account_events(spark, sf_dir), inputs.ACCOUNTS), "_seq")


@query
def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes that no TRUNCATE of their table hides."""
    kept = sta.after_truncate(_account_events(spark, sf_dir))
    return kept.select("_seq", "_op", F.element_at("_key", 1).alias("key"), F.element_at("_from", 1).alias("old_key"))


@query
def unchanged_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change with the values that it left unchanged."""
    filled = sta.fill_unchanged(_account_events(spark, sf_dir), inputs.ACCOUNTS).filter(F.col("_op").isin("I", "U"))
    return filled.select("_seq", "id", "note", F.size("_unchanged").alias("unknown"))


@query
def incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state kept up in four batches, one of them applied twice."""
    kept = CurrentTable(shared_folder(spark, "state"), inputs.ACCOUNTS, 16)
    last = inputs.table(spark, sf_dir, "orders").agg(F.max("o_orderkey") + 1).scalar()
    quarter = F.expr("_seq div 4") * 4 / last
    events = _account_events(spark, sf_dir)
    for n in (0, 1, 2, 1, 3):
        kept.apply(events.filter(F.floor(quarter) == n))
    return _account_rows(kept.read(spark), "_cdc_position")


@query
def reconciled_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded in four ranges while it changed, and its log: one state, and which loaded rows no change overtook.

    Each range of customers was read as the table was at an order of its own, between marks a twentieth of the orders before and after.
    """
    orders = inputs.table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).scalar()
    chunk = F.col("customer") % 4
    share = lambda twentieths: F.floor(last * (10 + 2 * chunk + twentieths) / 20)
    history = _landed(inputs.accounts(spark, sf_dir), "state-history").filter(~F.col("truncates"))
    cut = inputs.table(spark, sf_dir, "orders").agg(F.expr("max(o_orderkey) div 3L")).scalar()
    history = history.filter((F.col("n") > cut) & (F.col("n") <= share(0)))
    # The note a row had then is the last one told; rows start with an insert, which tells it.
    note = F.max_by(F.when(F.col("note_kind") == "t", F.col("note")), F.when(F.col("note_kind") != "u", F.col("n")))
    latest = F.max_by(F.struct("op", "id", "status", "price"), "n")
    rows = history.groupBy("customer").agg(latest.alias("r"), note.alias("note")).filter("r.op <> 'D'").select("customer", "r.*", "note")
    rows = rows.withColumns({"_low": inputs.account_position(share(-1)), "_high": inputs.account_position(share(1))})
    rows = _landed(rows, "state-rows")
    marks = rows.select(F.array(F.col("id").cast("string")).alias("_key"), "_low", "_high")
    loaded = sta.snapshot_events(rows, inputs.ACCOUNTS, ["id"], F.lit("s1"), F.col("_low")).join(marks, "_key")
    loaded = _landed(loaded, "state-snapshot")
    events = _account_events(spark, sf_dir)
    kept = sta.reconcile(loaded, events).select("id", F.lit(True).alias("kept"))
    # The log is applied from the lowest mark on, that of the first range, whether it held rows or not.
    later = events.filter(F.col("_position") > inputs.account_position(F.floor(last * 9 / 20)))
    state = sta.current_state(loaded.select(later.columns).unionByName(later), inputs.ACCOUNTS)
    of_log = F.when(F.col("_seq") < sta.LAST_SEQ, F.col("_seq"))
    state = _account_rows(state.withColumn("position", of_log), "position")
    return state.join(kept, "id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


@query
def stream_positions_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last commits of two streams whose positions cross, for the tables of each."""
    log = inputs.changes(spark, sf_dir)
    odd = F.expr("seq div 4") % 2 == 1
    second = log.filter(odd).withColumn("lsn", F.concat(F.lit("7F"), "lsn"))
    both = log.filter(~odd).unionByName(second.withColumn("stream_id", F.lit("s2")))
    tables = both.filter(F.col("rel_oid").isNotNull() & chg.is_change())
    tables = tables.select("stream_id", F.concat(F.lit("t_"), F.col("rel_oid").cast("string")).alias("table_name"))
    return stream_positions(both, tables)


@query
def quantile_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges over a skewed key: two fifths of the line items have one value, the others crowd at the low end.

    For each range with a value of its own that value and its rows; for the others how many rows they hold, and whether none holds more than twice the mean.
    """
    line = inputs.table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_linenumber") <= 2, 1000).otherwise(F.col("l_partkey") * F.col("l_partkey") + 1001)
    rows = line.select(key.cast("bigint").alias("k"))
    chunks = snap.quantile_chunks(rows, "k", 20)
    found = snap.chunked_snapshot(rows, chunks).groupBy("chunk").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("rows"))
    found = found.withColumn("value", F.when(F.col("low") == F.col("high"), F.col("low")))
    fair = F.max("rows") <= 2 * F.avg("rows")
    return found.groupBy("value").agg(F.sum("rows").alias("rows"), fair.alias("fair"))


@query
def cursor_increment_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read twice by their date, the second time with more of the last day seen, later days, and some that came late."""
    root = shared_folder(spark, "cursor")
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    middle = orders.agg(F.percentile("o_orderkey", 0.5)).scalar()
    day = orders.filter(F.col("o_orderkey") >= middle).agg(F.min_by("day", "o_orderkey")).scalar()
    odd = F.col("o_orderkey") % 2 == 1
    first = orders.filter(((F.col("day") < day) & (F.col("o_orderkey") % 17 != 0)) | ((F.col("day") == day) & odd))
    destination, store = Destination(base_path=f"{root}/out"), ProgressStore(f"{root}/state")
    late = []
    for rows in (first, orders, orders):
        late.append(read_increment(spark, rows, "orders", "day", ["o_orderkey"], destination, "orders", store, inputs.INGEST_TS)[1])
    return destination.read(spark, "orders").select("o_orderkey", "batch_id", F.lit(late[1]).cast("bigint").alias("late"))


@query
def malformed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the topic job counted by the way: values that didn't fit their columns, by batch and column."""
    root = shared_folder(spark, "malformed")
    messages = inputs.dirty_topic(spark, sf_dir)
    messages.repartition(4, "partition").write.parquet(f"{root}/messages")
    stream = spark.readStream.schema(messages.schema).parquet(f"{root}/messages")
    fields = (Field("k", "TIME"), Field("other", "INT64"))
    entry = Stream("events", "events", "cdc", True, fields)
    store = ProgressStore(f"{root}/state")
    sync_topic(spark, stream, Destination(base_path=f"{root}/out"), [entry], store, clock=_clock)
    return malformed(spark, store, "events")


@query
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, relations = inputs.versioned_orders(spark, sf_dir)
    versions = ver.relation_versions(relations)
    # One row per column of one table.
    columns = ver.merged_columns(versions).filter(F.col("table_name") == "shop.orders").collect()
    rows = ver.landed(ver.in_force(changes, versions), columns)
    return rows.withColumns({"version": F.col("version").cast("bigint"), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")})
