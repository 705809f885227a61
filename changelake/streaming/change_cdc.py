"""A change stream routed to its tables.

Messages arrive in files, in any order. A transaction may span micro-batches and its parts may come in
any order: what isn't part of a whole transaction yet waits in a state folder and is taken up once a
message arrives that may complete it. What was applied is noted, so a message that is delivered again
changes nothing, and one that comes late but was never applied is applied then.

    <store>/g=<n>/cdc/held/batch=<b>        messages that wait, as of batch b
    <store>/g=<n>/cdc/relations/batch=<b>   relations that batch b announced
    <store>/g=<n>/cdc/applied/batch=<b>     places of the messages that batch b applied, as intervals
    <store>/g=<n>/cdc/work/batch=<b>        steps of batch b, each written once and dropped at its end
    <store>/g=<n>/cdc/<name>-all/batch=<b>  what all batches before b wrote, merged: the applied places, and the relations
    <store>/g=<n>/cdc/commits/batch=<b>     per stream: last commit, first batch that holds messages, whether BEGINs carry the final LSN

The nearest BEGIN before a message and the nearest COMMIT after it may be those of two transactions, where the
COMMIT and the BEGIN between them are still to come. They are one transaction's only if nothing says otherwise: their
transaction ids don't differ, and where the stream's BEGINs carry the final LSN it is that of the COMMIT.

Batch b reads the state of the batches before it and writes its own, so a batch that is repeated gives the
same result.
"""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changelake.functions.positions import format_lsn, parse_lsn
from changelake.functions.types import OPERATION_COLUMN, Field
from changelake.operators.catalog import CDC
from changelake.operators.changes import DATA_TYPES, MESSAGE_SCHEMA, resolve_relation
from changelake.operators.intervals import border_marks, islands, merged, outside
from changelake.operators.ordered import BLOCK_WIDTH, UPPER_WIDTH, nearest_markers
from changelake.operators.progress import sync_counts
from changelake.operators.records import add_cdc_metadata, change_operation, split_rejects
from changelake.operators.state import table_events
from changelake.plans.change_log import table_changes
from changelake.plans.config import CHECKPOINT_INTERVAL_MS, Destination
from changelake.plans.current_table import CurrentTable
from changelake.plans.progress_store import GLOBAL, ProgressStore, note_malformed
from changelake.session import small_frame
from changelake.sinks import folders
from changelake.streaming.topic_cdc import utc_now

COMMITS = "stream_id string, commit_seq bigint, last_position bigint, held_from bigint, final_lsn boolean"
MARK = "struct<msg_type:string,xid:bigint,seq:bigint,lsn:string>"
APPLIED = f"stream_id string, seq_from bigint, seq_to bigint, first_mark {MARK}, last_mark {MARK}"
RELATION = ("rel_namespace", "rel_table", "rel_columns")
KEPT_BATCHES = 10
# Batches whose state is merged into one folder.
MERGED_BATCHES = 32
TABLES_AT_ONCE = 4

log = logging.getLogger(__name__)


class _State:
    """State folders of the batches. A folder is left out where a batch has nothing to write."""

    def __init__(self, root: str):
        self.root = root

    def _batches(self, spark: SparkSession, name: str) -> list[int]:
        return folders.numbered(spark, f"{self.root}/{name}", "batch=")

    def latest(self, spark: SparkSession, name: str, before: int, schema) -> DataFrame:
        """What the last batch before `before` wrote that wrote anything."""
        found = [b for b in self._batches(spark, name) if b < before]
        if not found:
            return small_frame(spark, [], schema)
        return spark.read.schema(schema).parquet(f"{self.root}/{name}/batch={found[-1]}")

    def all(self, spark: SparkSession, name: str, before: int, schema) -> DataFrame | None:
        """What all batches before `before` wrote."""
        whole, later = self._parts(spark, name, before)
        paths = [f"{self.root}/{name}-all/batch={b}" for b in whole] + [f"{self.root}/{name}/batch={b}" for b in later]
        return spark.read.schema(schema).parquet(*paths) if paths else None

    def _parts(self, spark: SparkSession, name: str, before: int) -> tuple[list[int], list[int]]:
        """The last merged folder up to `before`, if any, and the batches since then."""
        whole = [b for b in self._batches(spark, f"{name}-all") if b <= before and folders.exists(spark, f"{self.root}/{name}-all/batch={b}/_SUCCESS")][-1:]
        return whole, [b for b in self._batches(spark, name) if (whole[0] if whole else 0) <= b < before]

    def merge(self, spark: SparkSession, name: str, before: int, schema, how: Callable[[DataFrame], DataFrame]) -> None:
        """Put what many batches before `before` wrote into one folder."""
        if len(self._parts(spark, name, before)[1]) >= MERGED_BATCHES:
            self.write(how(self.all(spark, name, before, schema)), f"{name}-all", before)

    def held(self, spark: SparkSession, first: dict[str, int], before: int) -> DataFrame | None:
        """Messages that wait in the streams of `first`, each from its first batch on."""
        found = [b for b in self._batches(spark, "held") if min(first.values()) <= b < before]
        if not found:
            return None
        with_batch = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField("batch", T.LongType())])
        reader = spark.read.schema(with_batch).option("basePath", f"{self.root}/held")
        rows = reader.parquet(*[f"{self.root}/held/batch={b}" for b in found])
        begun = small_frame(spark, list(first.items()), "stream_id string, _first bigint")
        return rows.join(begun, "stream_id").filter(F.col("batch") >= F.col("_first"))

    def write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def step(self, df: DataFrame, name: str, batch: int) -> DataFrame:
        """The same rows, written once, so that what follows is planned and repeated from here."""
        path = f"{self.root}/work/batch={batch}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def end(self, spark: SparkSession, batch: int) -> None:
        folders.remove(spark, f"{self.root}/work/batch={batch}")

    def retire(self, spark: SparkSession, before: int) -> None:
        """Drop what no batch from `before` on can need."""
        for name in ("held", "commits"):
            old = [b for b in self._batches(spark, name) if b < before]
            for b in old if name == "held" else old[:-1]:
                folders.remove(spark, f"{self.root}/{name}/batch={b}")
        for name in ("applied", "relations"):
            whole, _ = self._parts(spark, name, before)
            for b in whole:
                for old, at in ((o, n) for n in (name, f"{name}-all") for o in self._batches(spark, n) if o < b):
                    folders.remove(spark, f"{self.root}/{at}/batch={old}")


def _placed(rows: DataFrame, markers: DataFrame, upper_width: int | None, size: int) -> DataFrame:
    """Add the nearest BEGIN or COMMIT on either side."""
    return nearest_markers(
        rows, markers, ["stream_id"], "seq", value=F.struct("msg_type", "xid", "seq", "lsn"),
        before="_begin", after="_commit", upper_width=upper_width, size=size,
    )


def _final_lsn() -> Column:
    """Whether a placed message shows that its stream's BEGINs carry the final LSN, not the place where they stand.

    A row change has then a lower LSN than the BEGIN before it, or a COMMIT the same.
    """
    at, begin = parse_lsn(F.col("lsn")), parse_lsn(F.col("_begin.lsn"))
    shown = F.when(F.col("msg_type") == "C", at == begin).when(F.col("msg_type") != "B", (at > 0) & (at < begin))
    return F.coalesce((F.col("_begin.msg_type") == "B") & shown, F.lit(False))


def _whole(final_lsn: list[str]) -> Column:
    """Whether a placed message is part of a whole transaction; `final_lsn` are the streams whose BEGINs carry that."""
    own, is_begin, is_commit = F.struct("msg_type", "xid", "seq", "lsn"), F.col("msg_type") == "B", F.col("msg_type") == "C"
    begin = F.when(is_begin, own).otherwise(F.col("_begin"))
    commit = F.when(is_commit, own).otherwise(F.col("_commit"))
    same = F.coalesce(begin["xid"] == commit["xid"], F.lit(True))
    same &= ~F.col("stream_id").isin(final_lsn) | (parse_lsn(begin["lsn"]) == parse_lsn(commit["lsn"]))
    return F.coalesce((begin["msg_type"] == "B") & (commit["msg_type"] == "C") & same, F.lit(False))


def named_positions(positions: dict[str, int], tables: list[str]) -> dict[str, int | None]:
    """Positions under the names they are saved by. Those of different streams can't be compared.

    The position of the one stream there is holds for all tables and is the global one; of several streams each keeps its own.
    """
    if len(positions) == 1:
        return dict.fromkeys([*tables, GLOBAL], next(iter(positions.values())))
    return dict.fromkeys(tables) | {f"{GLOBAL}/{s}": p for s, p in positions.items()}


def change_cdc(
    messages: DataFrame,
    tables: dict[str, tuple[str, list[Field]]],
    destination: Destination,
    store: ProgressStore,
    start_positions: dict[str, int] | None = None,
    clock: Callable[[], datetime.datetime] = utc_now,
    available_now: bool = True,
    interval_ms: int = CHECKPOINT_INTERVAL_MS,
    states: dict[str, tuple[CurrentTable, list[str]]] | None = None,
) -> StreamingQuery:
    """Start the stream. `tables` maps a source table to its destination table and fields, `states` to its current state to keep up and its key.

    The change logs hold row changes; TRUNCATEs only change states.

    Transactions committed at or before the start position of their stream are passed over: the
    snapshot has them.
    """
    spark = messages.sparkSession
    generation = store.generation(spark)
    folder = store.folder(spark)
    state = _State(f"{folder}/cdc")
    targets = list(tables)

    def sorted_out(batch: DataFrame, number: int, cached: list[DataFrame]) -> tuple[DataFrame, dict[str, int]] | None:
        """Changes of the wanted tables in transactions that are whole now; writes the state of this batch.

        Returns them with the last commit position of each stream, or nothing where no transaction
        became whole.
        """
        kind = F.col("msg_type")
        # One row per stream, a handful: they are planned with on the driver.
        old = {r.stream_id: r for r in state.latest(spark, "commits", number, COMMITS).collect()}
        heads = {
            r.stream_id: r
            for r in batch.groupBy("stream_id").agg(
                F.min("seq").alias("first"),
                F.max("seq").alias("last"),
                F.count(F.lit(1)).alias("messages"),
                F.count(F.when(kind == "C", 1)).alias("commits"),
                F.count(F.when(kind == "B", 1)).alias("begins"),
                F.count(F.when(kind == "R", 1)).alias("relations"),
            ).collect()
        }
        held_from = {s: r.held_from for s, r in old.items() if r.held_from is not None}
        late = [
            s for s, r in heads.items()
            if s in old and old[s].commit_seq is not None and r.first <= old[s].commit_seq
        ]
        # Streams in which a transaction may have become whole, or a table known.
        closing = [
            s for s, r in heads.items()
            if r.commits or r.relations or s in late or (r.begins and s in held_from)
        ]
        # Windows over blocks hold as many as the batch touches; only one that is spread very far is worth another level.
        wide = any(r.last - r.first >= BLOCK_WIDTH * UPPER_WIDTH for r in heads.values())
        upper = UPPER_WIDTH if wide else None
        relations = batch.filter(kind == "R")
        known = state.all(spark, "relations", number, MESSAGE_SCHEMA)
        if any(r.relations for r in heads.values()):
            state.write(relations, "relations", number)
        known = relations if known is None else known.unionByName(relations)
        known = known.dropDuplicates(["stream_id", "rel_oid", "seq"])

        rows = batch.filter(kind.isin("B", "C", "T", *DATA_TYPES))
        waiting, rows = rows.filter(~F.col("stream_id").isin(closing)), rows.filter(F.col("stream_id").isin(closing))
        taken_up = {s: held_from[s] for s in closing if s in held_from}
        earlier = state.held(spark, taken_up, number) if taken_up else None
        size = sum(r.messages for r in heads.values())
        if earlier is not None:
            rows = rows.unionByName(earlier.select(rows.columns))
            size += earlier.count()
        if earlier is not None or late:
            rows = rows.dropDuplicates(["stream_id", "seq"])
        markers = rows.filter(kind.isin("B", "C"))
        applied = state.all(spark, "applied", number, APPLIED) if late else None
        if applied is not None:
            # Something came at or before the last commit: what was applied before is left out, and what wasn't finds its
            # transaction among those that were.
            applied = applied.filter(F.col("stream_id").isin(late))
            rows = state.step(outside(rows, applied, ["stream_id"], "seq", upper_width=upper, size=size), "rows", number)
            borders = border_marks(applied, ["stream_id"])
            markers = rows.filter(kind.isin("B", "C")).select(borders.columns).unionByName(borders)
        # A table that was not announced yet may be announced by a file that is still to come.
        named = resolve_relation(rows, known, truncates=True, upper_width=upper, size=size).unionByName(rows.filter(kind.isin("B", "C")), allowMissingColumns=True)
        named = state.step(named, "named", number)
        placed = _placed(named, markers.select("stream_id", "seq", "lsn", "msg_type", "xid"), upper, size).persist()
        cached.append(placed)
        shown = placed.groupBy("stream_id").agg(F.max(_final_lsn()).alias("final_lsn")).where("final_lsn").collect()
        final_lsn = sorted({r.stream_id for r in shown} | {s for s, r in old.items() if r.final_lsn})
        unknown = F.col("table_name").startswith("unknown.") & ~F.col("table_name").isin(targets)
        unknown = F.coalesce(unknown, F.lit(False))
        placed = placed.withColumn("_whole", _whole(final_lsn) & ~unknown)

        found = {
            r.stream_id: r
            for r in placed.groupBy("stream_id").agg(
                F.count(F.when(~F.col("_whole"), 1)).alias("held"),
                F.count(F.when(F.col("_whole"), 1)).alias("ready"),
                F.max(F.when(F.col("_whole") & (kind == "C"), F.col("seq"))).alias("commit_seq"),
                F.max(F.when(F.col("_whole") & (kind == "C"), parse_lsn(F.col("lsn")))).alias("last_position"),
            ).collect()
        }
        for s in late:
            log.info("%s: messages at or before its last commit arrived in batch %s", s, number)
        held = placed.filter(~F.col("_whole")).select(
            *[F.col(f.name) if f.name not in RELATION else F.lit(None).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA]
        )
        new_held = {s for s, r in found.items() if r.held} | (set(heads) - set(closing))
        if new_held:
            state.write(held.unionByName(waiting.select(held.columns)), "held", number)
        ready = placed.filter("_whole")
        if any(r.ready for r in found.values()):
            mark = F.when(kind.isin("B", "C"), F.struct("msg_type", "xid", "seq", "lsn"))
            state.write(islands(ready, ["stream_id"], "seq", mark), "applied", number)

        commits = []
        for s in sorted({*old, *heads}):
            was, now_ = old.get(s), found.get(s)
            seqs = [x for x in (was and was.commit_seq, now_ and now_.commit_seq) if x is not None]
            ends = [x for x in (was and was.last_position, now_ and now_.last_position) if x is not None]
            if s in closing:
                since = number if s in new_held else None
            else:
                since = held_from.get(s, number if s in new_held else None)
            commits.append((s, max(seqs, default=None), max(ends, default=None), since, s in final_lsn))
        state.write(small_frame(spark, commits, COMMITS), "commits", number)
        needed = [c[3] for c in commits if c[3] is not None] + list(held_from.values())
        state.merge(spark, "applied", number, APPLIED, lambda df: merged(df, ["stream_id"]))
        state.merge(spark, "relations", number, MESSAGE_SCHEMA, lambda df: df.dropDuplicates(["stream_id", "rel_oid", "seq"]))
        state.retire(spark, min([*needed, number - KEPT_BATCHES]))
        if not any(r.ready for r in found.values()):
            return None
        changes = ready.filter(kind.isin("T", *DATA_TYPES) & F.col("table_name").isin(targets)).select(
            *[c for c in placed.columns if c not in ("rel_namespace", "rel_table", "_begin", "_commit", "_whole")],
            F.col("_begin.xid").alias("tx_xid"),
            F.col("_commit.seq").alias("commit_seq"),
            F.col("_commit.lsn").alias("commit_lsn"),
        )
        return changes, {c[0]: c[2] for c in commits if c[2] is not None}

    def write(batch: DataFrame, number: int) -> None:
        now = clock()
        batch_id = f"cdc-{generation}-{number:010d}"
        batch = batch.persist()
        cached = [batch]
        try:
            found = sorted_out(batch, number, cached)
            if found is None:
                return
            changes, positions = found
            changes = add_cdc_metadata(changes, change_operation(), F.lit(now))
            for stream_id, start in (start_positions or {}).items():
                passed = parse_lsn(F.col("commit_lsn")) <= start
                passed = (F.col("stream_id") == stream_id) & F.coalesce(passed, F.lit(False))
                changes = changes.filter(~passed)
            changes = changes.persist()
            cached.append(changes)
            counts = sync_counts(changes).collect()
            for r in counts:
                log.info("%s: %s %s", r.table_name, r.records, r[OPERATION_COLUMN])

            def write_table(table: str) -> None:
                name, fields = tables[table]
                if table in (states or {}):
                    current, key = states[table]
                    current.apply(table_events(changes.filter(F.col("table_name") == table), fields, key))
                if table not in changed:
                    return
                seen = Observation() if destination.type == "parquet" else None
                good, _ = split_rejects(table_changes(changes, table, fields, seen))
                _, rejected = split_rejects(table_changes(changes, table, fields))
                # Each partition of the batch may hold a few rows of each table: gather them into
                # files of a fair size.
                destination.write_batch(good.hint("rebalance"), name, batch_id, now.date())
                if seen is not None:
                    note_malformed(spark, store, name, batch_id, seen.get)
                if any(not f.nullable for f in fields) and not rejected.isEmpty():
                    destination.write_batch(rejected, f"{name}__rejects", batch_id, now.date())

            # The threads take over the stream's job group, so stopping it stops them as well.
            touched = sorted({r.table_name for r in counts})
            changed = {r.table_name for r in counts if r[OPERATION_COLUMN] != "TRUNCATE"}
            inherit = inheritable_thread_target(batch.sparkSession)
            with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
                list(pool.map(inherit(write_table), touched))

            update = small_frame(
                spark,
                [(name, CDC, p, now) for name, p in named_positions(positions, list(tables)).items()],
                "stream_id string, sync_mode string, last_position bigint, "
                "last_sync_time timestamp",
            )
            update = update.withColumn("last_lsn", format_lsn(F.col("last_position")))
            store.update(spark, streams=update)
        finally:
            for df in cached:
                df.unpersist()
            state.end(spark, number)

    writer = messages.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{folder}/checkpoint-cdc"
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()
