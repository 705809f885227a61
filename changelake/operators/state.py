"""The state of a table from its change log.

Events are the rows of one table that these functions work on:

    _stream string, _seq bigint, _position bigint   stream, place in it, and commit position
    _op string        I, U, D, T, or S for a row of a snapshot
    _key array        key columns as text; null for a TRUNCATE
    _from array       an UPDATE's old key, where it changed the key
    _unchanged array  names of columns whose value the event doesn't carry (unchanged TOAST values)
    _since map        of a kept state: the places of columns whose value is older than the row
    and the table's typed columns

A table's events come from one stream. They are ordered by commit position and place in the stream, which give the same
order. Of equal events one counts, so repeated deliveries change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.casts import cast_text
from changelake.functions.positions import parse_lsn
from changelake.functions.types import SPARK_TYPES, Field
from changelake.operators.changes import image_columns, tuple_items
from changelake.operators.ordered import BLOCK_WIDTH, carried_forward
from changelake.session import shared_folder

PLACE = "struct<position:bigint,seq:bigint>"
#: Place of snapshot rows among events of one position: after them, as the snapshot has seen them.
LAST_SEQ = (1 << 63) - 1
EVENT_COLUMNS = ("_stream", "_seq", "_position", "_op", "_key", "_from", "_unchanged", "_since")


def place() -> Column:
    return F.struct(F.col("_position").alias("position"), F.col("_seq").alias("seq"))


def _key_fields(fields: list[Field], key: list[str]) -> list[Field]:
    by_name = {f.name: f for f in fields}
    return [by_name[k] for k in key]


def key_text(columns: list[Column]) -> Column:
    """A key from typed columns: one text each, so that snapshot and log agree on its form."""
    return F.array(*[c.cast("string") for c in columns])


def table_events(changes: DataFrame, fields: list[Field], key: list[str]) -> DataFrame:
    """Committed changes and TRUNCATEs of one table, resolved, as events.

    An UPDATE has a `_from` if its old tuple holds a whole key that differs. A key column whose value is unchanged
    is taken from the old tuple.
    """
    keys = _key_fields(fields, key)
    old, new = tuple_items(F.col("old_tuple"), keys), tuple_items(F.col("new_tuple"), keys)

    def typed(item: Column, f: Field) -> Column:
        return cast_text(F.when(item["kind"] == "t", item["text"]), f.type)

    old_key = [typed(o, f) for o, f in zip(old, keys)]
    new_key = [F.when(n["kind"] == "u", typed(o, f)).otherwise(typed(n, f)) for o, n, f in zip(old, new, keys)]
    after = F.col("msg_type").isin("I", "U")
    unchanged = [
        F.when(v["kind"] == "u", f.name) for f, v in zip(fields, tuple_items(F.col("new_tuple"), fields)) if f.name not in key
    ]
    before, now = key_text(old_key), key_text(new_key)
    whole = ~F.exists(before, F.isnull)
    key_values = {f.name: F.when(after, n).otherwise(o) for f, o, n in zip(keys, old_key, new_key)}
    columns = [key_values[f.name].alias(f.name) if f.name in key_values else c for f, c in zip(fields, image_columns(fields))]
    return changes.select(
        F.col("stream_id").alias("_stream"),
        F.col("seq").alias("_seq"),
        parse_lsn(F.col("commit_lsn")).alias("_position"),
        F.col("msg_type").alias("_op"),
        F.when(after, now).when(F.col("msg_type") == "D", before).alias("_key"),
        F.when((F.col("msg_type") == "U") & whole & (before != now), before).alias("_from"),
        F.when(after, F.array_compact(F.array(*unchanged)) if unchanged else F.array().cast("array<string>")).alias("_unchanged"),
        F.lit(None).cast(f"map<string,{PLACE}>").alias("_since"),
        *columns,
    )


def snapshot_events(rows: DataFrame, fields: list[Field], key: list[str], stream: Column, position: Column) -> DataFrame:
    """Rows of a snapshot as events: what the log holds up to `position` is in them."""
    return rows.select(
        stream.cast("string").alias("_stream"),
        F.lit(LAST_SEQ).alias("_seq"),
        position.cast("bigint").alias("_position"),
        F.lit("S").alias("_op"),
        key_text([F.col(f"`{k}`").cast(SPARK_TYPES[f.type]) for k, f in zip(key, _key_fields(fields, key))]).alias("_key"),
        F.lit(None).cast("array<string>").alias("_from"),
        F.array().cast("array<string>").alias("_unchanged"),
        F.lit(None).cast(f"map<string,{PLACE}>").alias("_since"),
        *[F.col(f"`{f.name}`").cast(SPARK_TYPES[f.type]).alias(f.name) for f in fields],
    )


def last_truncate(events: DataFrame) -> Column:
    """Place of the last TRUNCATE, as a scalar; null if there is none."""
    return events.filter(F.col("_op") == "T").agg(F.max(place())).scalar()


def after_truncate(events: DataFrame, truncated: Column | None = None) -> DataFrame:
    """The events that no TRUNCATE hides: those after the last one (or `truncated`, if that is later).

    The TRUNCATE itself is a tombstone for all that is before it, however late it is read; it stays out.
    """
    last = last_truncate(events)
    if truncated is not None:
        last = F.greatest(last, truncated.cast(PLACE))
    return events.filter(F.col("_op") != "T").filter(last.isNull() | (place() > last))


def _carries(name: str) -> Column:
    """Whether an event says what a column's value is."""
    return F.col("_op").isin("I", "U", "S") & ~F.array_contains("_unchanged", name)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the folder that all executors share."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at_old_keys(events: DataFrame) -> DataFrame:
    """The events under their keys, and each change of key once more as the end of the row under its old key."""
    gone = events.filter(F.col("_from").isNotNull()).withColumns({"_op": F.lit("D"), "_key": F.col("_from")})
    return events.unionByName(gone.withColumns({"_unchanged": F.lit(None).cast("array<string>"), "_since": F.lit(None).cast(f"map<string,{PLACE}>")}))


def moved_values(events: DataFrame, fields: list[Field], width: int = BLOCK_WIDTH) -> DataFrame:
    """The events; UPDATEs that change the key get the unchanged values from the row under its old key.

    That row may have come from another key itself, so values are looked up along chains of such changes, by doubling the steps each
    round. Only events of keys that rows moved from or to, with values left unchanged, are shuffled for it. A value that neither log nor snapshot
    ever held is null.
    """
    moved = events.filter(F.col("_from").isNotNull() & (F.size("_unchanged") > 0))
    if moved.isEmpty():
        return events
    names = [f.name for f in fields]
    marks = F.struct(
        *[
            F.when(_carries(n), F.struct(F.col(f"`{n}`").alias("value"), F.lit(None).cast("bigint").alias("link")))
            .when((F.col("_op") == "U") & F.col("_from").isNotNull(), F.struct(F.lit(None).cast(SPARK_TYPES[f.type]).alias("value"), F.col("_seq").alias("link")))
            .alias(n)
            for n, f in zip(names, fields)
        ]
    )
    # What is known under the keys, and rows without values where each look-up stands, just before the change. A snapshot's rows come first in their stream's order.
    both = moved.select(F.explode(F.array("_from", "_key")).alias("_key")).distinct()
    known = events.join(both, "_key", "left_semi")
    order = F.when(F.col("_op") == "S", F.lit(-1).cast("bigint")).otherwise(2 * F.col("_seq") + 1)
    known = known.select("_key", order.alias("_order"), marks.alias("_marks"), F.struct("_op").alias("_last"))
    probe = lambda key, old: moved.select(F.col(key).alias("_key"), (2 * F.col("_seq")).alias("_order"), "_seq", "_unchanged", F.lit(old).alias("_old"))
    values = {f"_m{i}": F.col("_marks")[n] for i, n in enumerate(names)} | {"_before": F.col("_last")}
    rows = known.unionByName(probe("_from", True), allowMissingColumns=True).unionByName(probe("_key", False), allowMissingColumns=True)
    found = carried_forward(rows, ["_key"], "_order", values, width).filter(F.col("_old").isNotNull())
    # If a snapshot's row is all that comes before the change under the new key, the snapshot has seen the row there already.
    shown = ~F.col("_old") & (F.col("_before._op") == "S")
    own = []
    for i, n in enumerate(names):
        mark = F.when(F.array_contains("_unchanged", n), F.col(f"_m{i}"))
        own.append(F.coalesce(F.first(F.when(F.col("_old"), mark), True), F.first(F.when(shown, mark), True)).alias(f"_m{i}"))
    links = _kept(found.groupBy("_seq").agg(*own), "moved-values")
    link = F.coalesce(*[F.col(f"_m{i}.link") for i in range(len(names))])
    while not links.filter(link.isNotNull()).isEmpty():
        ahead = links.select(F.col("_seq").alias("_link"), *[F.col(f"_m{i}").alias(f"_p{i}") for i in range(len(names))])
        joined = links.withColumn("_to", link).join(ahead, F.col("_to") == F.col("_link"), "left")
        step = [F.when(F.col(f"_m{i}.link").isNotNull(), F.col(f"_p{i}")).otherwise(F.col(f"_m{i}")).alias(f"_m{i}") for i in range(len(names))]
        links = _kept(joined.select("_seq", *step), "moved-values")
    ready = links.withColumn("_moved", F.lit(True))
    filled = [
        F.when(F.array_contains("_unchanged", n) & F.col("_moved"), F.col(f"_m{i}.value")).otherwise(F.col(f"`{n}`")).alias(n) for i, n in enumerate(names)
    ]
    none = F.array().cast("array<string>")
    return events.join(ready, "_seq", "left").select(
        *[F.when(F.col("_moved"), none).otherwise(F.col(c)).alias(c) if c == "_unchanged" else F.col(c) for c in EVENT_COLUMNS], *filled
    )


def fill_unchanged(events: DataFrame, fields: list[Field], width: int = BLOCK_WIDTH) -> DataFrame:
    """Every event with the values that it leaves unchanged, taken from the last event of its row that has them.

    Values are carried along the log in blocks, so a key with very many events is spread over tasks. A row keeps its values when
    its key changes. Values the log never held stay null and named in `_unchanged`. Other events, DELETEs and TRUNCATEs among
    them, are returned as they are.
    """
    names = [f.name for f in fields]
    size = events.count()
    events = moved_values(events, fields, width)
    marks = {f"_m{i}": F.when(_carries(n), F.struct(F.col(f"`{n}`").alias("value"))) for i, n in enumerate(names)}
    events = events.withColumn("_order", F.when(F.col("_op") == "S", F.lit(-1).cast("bigint")).otherwise(F.col("_seq")))
    rows = carried_forward(events, ["_key"], "_order", marks, width, size=size)
    missing = lambda n: F.coalesce(F.array_contains("_unchanged", n), F.lit(False))
    columns = [F.when(missing(n), F.col(f"_m{i}.value")).otherwise(F.col(f"`{n}`")).alias(n) for i, n in enumerate(names)]
    still = F.array_compact(F.array(*[F.when(missing(n) & F.col(f"_m{i}").isNull(), n) for i, n in enumerate(names)]))
    kept = [F.when(F.col("_unchanged").isNotNull(), still).alias(c) if c == "_unchanged" else F.col(c) for c in EVENT_COLUMNS]
    return rows.select(*kept, *columns)


def current_state(events: DataFrame, fields: list[Field], truncated: Column | None = None, keep_deleted: bool = False) -> DataFrame:
    """The last row of each key, as events: rows deleted, moved to another key or truncated are gone.

    One aggregation: the last writer of a key by commit position and place, and for each column the last event that carries it; no window, and a
    key with very many events is reduced before it is shuffled. With `keep_deleted`, deleted keys stay as D, so that older events that
    come later find them. Null keys are equal. No events, no rows.
    """
    live = after_truncate(moved_values(events, fields), truncated)
    entries = _at_old_keys(live)
    since = lambda n: F.coalesce(F.try_element_at("_since", F.lit(n)), place())
    last = F.max_by(F.struct("_op", "_stream"), place())
    columns = []
    for i, f in enumerate(fields):
        at = F.when(_carries(f.name), since(f.name))
        columns += [F.max_by(F.struct(F.col(f"`{f.name}`").alias("value")), at).alias(f"_v{i}"), F.max(at).alias(f"_a{i}")]
    grouped = entries.groupBy("_key").agg(F.max(place()).alias("_at"), last.alias("_last"), *columns)
    older = F.filter(
        F.array(*[F.struct(F.lit(f.name).alias("key"), F.col(f"_a{i}").alias("value")) for i, f in enumerate(fields)]),
        lambda e: e["value"].isNotNull() & (e["value"] != F.col("_at")),
    )
    lacking = F.array_compact(F.array(*[F.when(F.col(f"_a{i}").isNull(), f.name) for i, f in enumerate(fields)]))
    dead = F.col("_last._op") == "D"
    state = grouped.select(
        F.col("_last._stream").alias("_stream"), F.col("_at.seq").alias("_seq"), F.col("_at.position").alias("_position"),
        F.when(dead, "D").otherwise("S").alias("_op"), "_key", F.lit(None).cast("array<string>").alias("_from"),
        lacking.alias("_unchanged"), F.when(F.size(older) > 0, F.map_from_entries(older)).alias("_since"),
        *[F.col(f"_v{i}.value").alias(f.name) for i, f in enumerate(fields)],
    )
    return state if keep_deleted else state.filter(F.col("_op") != "D")


def reconcile(rows: DataFrame, events: DataFrame, low: str = "_low", high: str = "_high") -> DataFrame:
    """The snapshot rows (see `snapshot_events`, with the marks of their range) that no change between the marks overtakes.

    A range was read after the log stood at `low` and before it stood at `high`. A row whose key was changed, or moved to or from, in between may have been read before
    or after that; the log says what it is, so it is dropped in its favour. The others are as the log stood at either mark, but for a
    TRUNCATE in between, which comes after them in the log.
    """
    between = _at_old_keys(events.filter(F.col("_op") != "T")).select(F.col("_key").alias("_changed"), F.col("_position").alias("_when")).distinct()
    inside = (F.col("_when") > F.col(low)) & (F.col("_when") <= F.col(high))
    return rows.join(between, F.col("_key").eqNullSafe(F.col("_changed")) & inside, "left_anti")
