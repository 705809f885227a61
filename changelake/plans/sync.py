"""Sync: plan the streams of a catalog, load tables, then follow their changes."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators.catalog import CDC, stream_select, sync_plan
from changelake.functions.types import OPERATION_COLUMN, Field
from changelake.operators.progress import STREAM_SCHEMA
from changelake.operators.state import snapshot_events
from changelake.operators.transactions import last_commits
from changelake.plans import documents
from changelake.plans.config import CHECKPOINT_INTERVAL_MS, Destination, Stream, catalog_frame
from changelake.plans.current_table import CurrentTable
from changelake.plans.full_load import CHUNKS_PER_WAVE, full_load
from changelake.plans.progress_store import GLOBAL, ProgressStore
from changelake.plans.topic_log import only_stream
from changelake.session import small_frame
from changelake.sources.changelog import change_log, change_log_stream
from changelake.sources.tables import fields_by_table
from changelake.streaming.change_cdc import change_cdc
from changelake.streaming.topic_cdc import subscribe, topic_cdc, utc_now

TABLES_AT_ONCE = 4

log = logging.getLogger(__name__)


def start_positions(
    spark: SparkSession,
    log: DataFrame,
    store: ProgressStore,
    now: datetime.datetime,
    from_earliest: bool = False,
) -> dict[str, int]:
    """Position that each change stream starts after, fixed by the first call.

    That is the global position where progress was taken over from elsewhere, else the last
    commit landed so far, or none `from_earliest`. It is noted before any table is loaded, so no change between load and
    stream is lost. Positions of different streams can't be compared: a global one is refused where there are several.
    """
    prefix = f"{GLOBAL}_start/"
    saved = store.load(spark).streams.filter(F.col("stream_id").startswith(GLOBAL)).collect()
    noted = {r.stream_id: r.last_position for r in saved}
    if prefix not in noted:
        found = {}
        if not from_earliest:
            found = {prefix + r.stream_id: r.last_position for r in last_commits(log).collect()}
        if noted.get(GLOBAL) is not None and not from_earliest:
            names = [r.stream_id for r in log.select("stream_id").distinct().limit(2).collect()]
            if len(names) > 1:
                raise ValueError("a global position was taken over, but there are several change streams")
            found = {prefix + s: noted[GLOBAL] for s in names}
        noted = {prefix: None, **found}
        rows = [(k, None, None, v, None, None, None, now) for k, v in noted.items()]
        store.update(spark, streams=small_frame(spark, rows, STREAM_SCHEMA))
    return {
        k.removeprefix(prefix): v
        for k, v in noted.items()
        if k.startswith(prefix) and k != prefix and v is not None
    }


def sync(
    spark: SparkSession,
    source,
    messages: str | None,
    destination: Destination,
    streams: list[Stream],
    store: ProgressStore,
    full_refresh: bool = False,
    clock: Callable[[], datetime.datetime] = utc_now,
    chunks_per_wave: int = CHUNKS_PER_WAVE,
    from_earliest: bool = False,
    available_now: bool = True,
    files_per_trigger: int | None = 1000,
    interval_ms: int = CHECKPOINT_INTERVAL_MS,
    missing: str = "warn",
    states: str | None = None,
) -> dict[str, int]:
    """Run a sync over tables; returns the number of ranges loaded per table.

    Below the folder `states` the current state of each stream with a primary key is kept up (see `current_tables`).

    `source` lists and reads tables, `messages` is the folder where change messages land.
    With no saved progress changes count from now on; `from_earliest` takes all that landed. Streams that the
    source doesn't have are named in a warning, or refused with `missing="fail"`.
    """
    if full_refresh:
        store.reset(spark)
    catalog = catalog_frame(spark, streams)
    selected = stream_select(source.discover(spark), catalog)
    fields = fields_by_table(selected)
    absent = sorted({s.table for s in streams} - set(fields))
    if absent and missing == "fail":
        raise ValueError(f"not in the source: {', '.join(absent)}")
    if absent:
        log.warning("not in the source, passed over: %s", ", ".join(absent))
    chosen = catalog.filter(F.col("table").isin(list(fields)))
    steps = sync_plan(chosen, store.load(spark).streams).orderBy("table").collect()

    following = [s for s in steps if s.needs_cdc]
    positions = None
    if following and messages is not None:
        landed = change_log(spark, messages)
        positions = start_positions(spark, landed, store, clock(), from_earliest)

    def load(step) -> int:
        return full_load(
            spark, source, step.table, fields[step.table], destination, step.destination,
            store, clock(), chunks_per_wave,
        )

    # Several tables at once, so that a cluster is not kept waiting by the end of each.
    to_load = [s for s in steps if s.needs_full_load]
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        counts = list(pool.map(inheritable_thread_target(spark)(load), to_load))
    loaded = {s.table: n for s, n in zip(to_load, counts)}
    if following and messages is not None:
        kept = current_tables(spark, states, streams, following, fields, destination, store, positions) if states else {}
        query = change_cdc(
            change_log_stream(spark, messages, files_per_trigger),
            {s.table: (s.destination, fields[s.table]) for s in following},
            destination,
            store,
            positions,
            clock,
            available_now,
            interval_ms,
            kept,
        )
        query.awaitTermination()
    return loaded


def current_tables(
    spark: SparkSession, path: str, streams: list[Stream], steps: list, fields: dict[str, list[Field]], destination: Destination,
    store: ProgressStore, positions: dict[str, int],
) -> dict[str, tuple[CurrentTable, list[str]]]:
    """The states of the tables that have a primary key, in folders of the current generation.

    A new state begins with the rows that were loaded. They were read after the position where the stream starts, so they stand there: what
    changed meanwhile comes later in the log. Positions of different streams can't be compared; with several this is refused.
    """
    if len(positions) > 1:
        raise ValueError("states are kept for one change stream only")
    keys, out = {s.table: list(s.primary_key) for s in streams}, {}
    for step in steps:
        if not keys[step.table]:
            continue
        columns = fields[step.table]
        state = CurrentTable(f"{path}/g={store.generation(spark)}/{step.destination}", columns)
        if step.mode != CDC and state.version(spark) < 0:
            loaded = destination.read(spark, step.destination).filter(F.col(OPERATION_COLUMN) == "SNAPSHOT")
            loaded = loaded.filter(F.col("batch_id").startswith(f"load-{store.generation(spark)}-"))
            at = F.lit(next(iter(positions.values()), -1))
            state.apply(snapshot_events(loaded, columns, keys[step.table], F.lit(None), at))
        out[step.table] = (state, keys[step.table])
    return out


def sync_topic(
    spark: SparkSession,
    messages: DataFrame,
    destination: Destination,
    streams: list[Stream],
    store: ProgressStore,
    full_refresh: bool = False,
    clock: Callable[[], datetime.datetime] = utc_now,
    available_now: bool = True,
    interval_ms: int = CHECKPOINT_INTERVAL_MS,
) -> None:
    """Run a sync over the one topic of the catalog."""
    if full_refresh:
        store.reset(spark)
    topic_cdc(
        messages, streams, destination, store, clock, available_now, interval_ms
    ).awaitTermination()


def sync_documents(
    spark: SparkSession,
    source: dict,
    catalog: dict,
    destination: dict,
    store: ProgressStore,
    full_refresh: bool = False,
    available_now: bool = True,
    **options,
) -> dict[str, int] | None:
    """Run the sync that three documents describe: of tables, whose document names the folder of `messages`, or of a topic."""
    streams, target = documents.streams(catalog), documents.destination(destination)
    found = documents.source(source)
    if not isinstance(found, documents.TopicSource):
        interval = source.get("checkpoint_interval_ms", CHECKPOINT_INTERVAL_MS)
        return sync(
            spark, found, source.get("messages"), target, streams, store, full_refresh,
            available_now=available_now, interval_ms=interval, **options,
        )
    if full_refresh:
        store.reset(spark)
    messages = subscribe(
        spark, found.servers, only_stream(streams), store, found.partitions, found.start, found.records,
        found.options, found.interval_ms,
    )
    sync_topic(
        spark, messages, target, streams, store, available_now=available_now, interval_ms=found.interval_ms, **options
    )
    return None
