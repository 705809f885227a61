"""Change messages to row images.

The message table holds one row per message of a change stream:

    stream_id string, seq bigint, lsn string, msg_type string, xid bigint, rel_oid bigint,
    rel_namespace string, rel_table string, rel_columns array<string>,
    old_tuple array<struct<kind string, text string>>, new_tuple (same), ts timestamp

`seq` is unique and ascending within a stream. A TRUNCATE of several tables is one message for each,
with its `rel_oid`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.casts import cast_text
from changelake.functions.types import Field
from changelake.operators.ordered import BLOCK_WIDTH, UPPER_WIDTH, nearest_markers

TUPLE = T.ArrayType(T.StructType().add("kind", "string").add("text", "string"))
MESSAGE_SCHEMA = (
    T.StructType()
    .add("stream_id", "string")
    .add("seq", "long")
    .add("lsn", "string")
    .add("msg_type", "string")
    .add("xid", "long")
    .add("rel_oid", "long")
    .add("rel_namespace", "string")
    .add("rel_table", "string")
    .add("rel_columns", T.ArrayType(T.StringType()))
    .add("old_tuple", TUPLE)
    .add("new_tuple", TUPLE)
    .add("ts", "timestamp")
)

# Message type letter -> name.
MESSAGE_TYPES = {
    "B": "BEGIN",
    "C": "COMMIT",
    "R": "RELATION",
    "I": "INSERT",
    "U": "UPDATE",
    "D": "DELETE",
    "T": "TRUNCATE",
}
DATA_TYPES = ["I", "U", "D"]


def is_change() -> Column:
    return F.col("msg_type").isin(DATA_TYPES)


def is_truncate() -> Column:
    return F.col("msg_type") == "T"


def classify_messages(log: DataFrame) -> DataFrame:
    """Name the message type and say whether the message carries a row."""
    kind = F.lit("UNKNOWN")
    for letter, name in MESSAGE_TYPES.items():
        kind = F.when(F.col("msg_type") == letter, name).otherwise(kind)
    return log.withColumns({"message": kind, "yields_row": F.coalesce(is_change(), F.lit(False))})


def resolve_relation(
    log: DataFrame, earlier: DataFrame | None = None, width: int = BLOCK_WIDTH, truncates: bool = False,
    upper_width: int | None = UPPER_WIDTH, size: int | None = None,
) -> DataFrame:
    """Give each row change the latest relation of its oid seen before it; with `truncates`, each TRUNCATE too.

    Adds `table_name` and replaces `rel_columns`. `earlier` holds relation messages of earlier
    batches, in the layout of the log. Relations are carried along the log in blocks, however many
    there are; a null oid has none. `size` is the number of messages, counted if it is not given.
    """
    is_relation = F.col("msg_type") == "R"
    relations = log.filter(is_relation)
    if earlier is not None:
        relations = relations.unionByName(earlier, allowMissingColumns=True)
    changes = log.filter(is_change() | is_truncate() if truncates else is_change())

    resolved = nearest_markers(
        changes,
        relations.filter(F.col("rel_oid").isNotNull()).select(
            "stream_id", "rel_oid", "seq", "rel_namespace", "rel_table", "rel_columns"
        ),
        ["stream_id", "rel_oid"],
        "seq",
        value=F.struct("rel_namespace", "rel_table", "rel_columns"),
        before="_relation",
        width=width,
        upper_width=upper_width,
        size=size,
    )

    known_name = F.concat_ws(".", "_relation.rel_namespace", "_relation.rel_table")
    unknown_name = F.concat(F.lit("unknown."), F.col("rel_oid").cast("string"))
    return resolved.select(
        *[c for c in log.columns if c not in ("rel_namespace", "rel_table", "rel_columns")],
        F.when(F.col("_relation").isNotNull(), known_name).otherwise(unknown_name).alias(
            "table_name"
        ),
        F.col("_relation.rel_columns").alias("rel_columns"),
    )


def tuple_to_columns(values: Column, names: Column) -> Column:
    """Tuple values as a map of column name to text.

    The i-th value gets the i-th name, or `col_<i>` where there is none. Null and unchanged
    values are null; a value of an unknown kind is left out. Of equal names the last counts.
    """
    # Nearly always the kinds are known and the names differ: one pass over the values.
    n, known = F.array_size(values), F.coalesce(F.array_size(names), F.lit(0))
    texts = F.transform(values, lambda v: F.when(v["kind"] == "t", v["text"]))
    extra = F.when(
        n > known,
        F.transform(
            F.sequence(known, n - 1), lambda i: F.concat(F.lit("col_"), i.cast("string"))
        ),
    )
    keys = (
        F.when(n == known, names)
        .when(n < known, F.slice(names, 1, n))
        .when(known == 0, extra)
        .otherwise(F.concat(names, extra))
    )
    plain = ~F.exists(
        values, lambda v: ~F.coalesce(v["kind"].isin("n", "u", "t"), F.lit(False))
    ) & ~F.coalesce(F.arrays_overlap(names, extra), F.lit(False))

    named = F.transform(
        values,
        lambda v, i: F.struct(
            F.coalesce(F.get(names, i), F.concat(F.lit("col_"), i.cast("string"))).alias("key"),
            F.when(v["kind"] == "t", v["text"]).alias("value"),
            v["kind"].alias("kind"),
        ),
    )
    kept = F.filter(named, lambda e: e["kind"].isin("n", "u", "t"))
    last_of_name = F.filter(
        kept,
        lambda e, i: ~F.exists(
            F.slice(kept, i + 2, F.array_size(kept)), lambda later: later["key"] == e["key"]
        ),
    )
    entries = F.transform(
        last_of_name, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    )
    return F.when(plain, F.map_from_arrays(keys, texts)).otherwise(F.map_from_entries(entries))


def before_after(changes: DataFrame) -> DataFrame:
    """Add the row images: `after` for inserts and updates, `before` for updates and deletes."""
    after = tuple_to_columns(F.col("new_tuple"), F.col("rel_columns"))
    before = tuple_to_columns(F.col("old_tuple"), F.col("rel_columns"))
    return changes.withColumns(
        {
            "after": F.when(F.col("msg_type").isin("I", "U"), after),
            "before": F.when(
                F.col("msg_type").isin("U", "D") & F.col("old_tuple").isNotNull(), before
            ),
        }
    )


def row_image(changes: DataFrame) -> DataFrame:
    """The image that is written: the row after the change, or else the row before it."""
    return changes.withColumn("image", F.coalesce("after", "before"))


def target_filter(changes: DataFrame, targets: DataFrame | list[str]) -> DataFrame:
    """Keep the changes of the target tables: a list of names, or a frame with `table_name`."""
    if not isinstance(targets, DataFrame):
        return changes.filter(F.col("table_name").isin(list(targets)))
    return changes.join(targets.select("table_name").distinct(), "table_name", "left_semi")


def tuple_items(values: Column, fields: Iterable[Field]) -> list[Column]:
    """For each field its item (kind, text) of a tuple of a resolved change; null where there is none."""
    width = F.coalesce(F.array_size("rel_columns"), F.lit(0))
    out = []
    for f in fields:
        place = F.array_position("rel_columns", f.name)
        if f.name.startswith("col_") and f.name[4:].isdigit():
            bare = int(f.name[4:])
            place = F.when(width <= bare, F.lit(bare + 1).cast("bigint")).otherwise(place)
        out.append(F.get(values, F.coalesce(place, F.lit(0)).cast("int") - 1))
    return out


def image_texts(fields: Iterable[Field]) -> dict[str, Column]:
    """The text of each field in the image that is written: the new tuple, or a DELETE's old one."""
    fields = list(fields)
    image = F.when(F.col("msg_type") == "D", F.col("old_tuple")).otherwise(F.col("new_tuple"))
    return {f.name: F.when(v["kind"] == "t", v["text"]) for f, v in zip(fields, tuple_items(image, fields))}


def image_columns(fields: Iterable[Field]) -> list[Column]:
    """Typed columns straight from the tuples of resolved changes, with no map in between.

    Gives what `before_after`, `row_image` and a projection by name give, in generated code.
    """
    fields = list(fields)
    texts = image_texts(fields)
    return [cast_text(texts[f.name], f.type).alias(f.name) for f in fields]
