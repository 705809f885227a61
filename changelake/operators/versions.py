"""Versions of tables along a change stream, and one schema that holds rows of all of them.

A relation message states a table's columns from its place on, with `rel_types array<string>` their types as the database
names them. A version is the span of places up to the next message that states something else. A column that was added, dropped or
given another type in between lands in one readable table: rows are read by the types in force at their place and then brought to a type that holds
every value of all versions unchanged, or to text where there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.casts import cast_text
from changelake.functions.types import Field, resolve_type, spark_type
from changelake.operators.ordered import BLOCK_WIDTH, nearest_markers

# Types (all of a set, not just one of them) that a wider one holds without loss; the first that fits counts.
WIDER = [
    ({"INT32", "INT64"}, "INT64"),
    ({"INT32", "FLOAT", "DOUBLE"}, "DOUBLE"),
    ({"INT32", "INT64", "DECIMAL"}, "DECIMAL"),
    ({"DATE", "TIMESTAMP"}, "TIMESTAMP"),
]
KEYS = ["stream_id", "rel_oid"]


def wider_type(types: Column) -> Column:
    """The type that holds every value of a set (array) of canonical types; an empty set has none."""
    out = F.when(F.size(types) == 1, F.get(types, F.lit(0)))
    for inside, wide in WIDER:
        out = out.when(F.size(F.array_except(types, F.array(*(F.lit(t) for t in sorted(inside))))) == 0, wide)
    return F.when(F.size(types) > 0, out.otherwise("STRING"))


def relation_versions(relations: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """stream_id, rel_oid, version (from 1), seq_from, seq_to (exclusive; null: still in force), table_name, columns (name, type).

    A message that says what the one before it said begins no version, however many there are: they are compared in blocks, and only those that differ are numbered in
    a window. Messages delivered twice count once; without an oid they count not at all. A type that is not stated is STRING; null columns are none.
    """
    names, types = F.coalesce("rel_columns", F.array().cast("array<string>")), F.col("rel_types")
    stated = F.transform(names, lambda n, i: F.struct(n.alias("name"), resolve_type(F.get(types, i)).alias("type")))
    told = (
        relations.filter(F.col("rel_oid").isNotNull())
        .select(*KEYS, "seq", F.concat_ws(".", "rel_namespace", "rel_table").alias("table_name"), stated.alias("columns"))
        .dropDuplicates([*KEYS, "seq"])
    )
    said = F.struct("table_name", "columns")
    changed = nearest_markers(told, told, KEYS, "seq", said, before="_was", width=width).filter(~said.eqNullSafe(F.col("_was")))
    along = Window.partitionBy(KEYS).orderBy("seq")
    return changed.select(
        *KEYS, F.row_number().over(along).alias("version"), F.col("seq").alias("seq_from"), F.lead("seq").over(along).alias("seq_to"), "table_name", "columns"
    )


def in_force(changes: DataFrame, versions: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Row changes with the version of their table that is in force at their place: table_name, version and columns.

    Versions are carried along the stream in blocks. All three are null before the first version.
    """
    markers = versions.select(*KEYS, F.col("seq_from").alias("seq"), "table_name", "version", "columns")
    value = F.struct("table_name", "version", "columns")
    found = nearest_markers(changes, markers, KEYS, "seq", value, before="_version", width=width)
    return found.select(*[c for c in changes.columns if c not in ("table_name", "version", "columns")], "_version.*")


def merged_columns(versions: DataFrame) -> DataFrame:
    """table_name, name, type, types (as stated, in order), place, missing: one row per column that any version of a table has.

    `place` orders them: by the first version that has the column, then by the place there. `missing` says that a version lacks it.
    A name that a version has twice counts as its first.
    """
    each = versions.select("table_name", *KEYS, "seq_from", F.posexplode("columns").alias("at", "column"))
    # Streams number their places on their own, so the stream comes after the place.
    first = F.min(F.struct("seq_from", "at", *KEYS))
    found = each.filter(F.col("column.name").isNotNull()).groupBy("table_name", F.col("column.name").alias("name")).agg(
        F.sort_array(F.collect_set("column.type")).alias("types"),
        F.count_distinct(*KEYS, "seq_from").alias("_in"),
        first.alias("_first"),
    )
    counts = versions.groupBy(F.col("table_name").alias("_of")).agg(F.count(F.lit(1)).alias("_versions"))
    order = Window.partitionBy("table_name").orderBy("_first")
    return found.join(counts, F.col("table_name") == F.col("_of")).select(
        "table_name", "name", wider_type(F.col("types")).alias("type"), "types",
        F.row_number().over(order).alias("place"), (F.col("_in") < F.col("_versions")).alias("missing"),
    )


def landed(changes: DataFrame, columns: list) -> DataFrame:
    """Changes with a version (`in_force`) as rows of one schema: one typed column for each row of `merged_columns` of one table.

    A value is read by its version's type (null if malformed there), then widened; where the column became text it is the text as it came. Columns that a version
    lacks are null. Kept beside: stream_id, seq, msg_type, version. The image is the new tuple, or a DELETE's old one.
    """
    image = F.when(F.col("msg_type") == "D", F.col("old_tuple")).otherwise(F.col("new_tuple"))
    names = F.transform("columns", lambda c: c["name"])
    out = []
    for column in sorted(columns, key=lambda c: c["place"]):
        at = F.coalesce(F.array_position(names, column["name"]), F.lit(0)).cast("int") - 1
        item, stated, wide = F.get(image, at), F.get("columns", at)["type"], column["type"]
        text = F.when(item["kind"] == "t", item["text"])
        value = text
        if wide != "STRING" or column["types"] != ["STRING"]:
            value = F.lit(None).cast(spark_type(wide))
            for kind in column["types"]:
                typed = text if wide == "STRING" else cast_text(text, kind).cast(spark_type(wide))
                value = F.when(stated == kind, typed).otherwise(value)
        described = {"cdc_type": wide, "missing": column["missing"]}
        out.append(value.alias(column["name"], metadata=described))
    return changes.filter(F.col("version").isNotNull()).select("stream_id", "seq", "msg_type", "version", *out)


def fields_of(columns: list) -> list[Field]:
    """The same columns as fields of a table."""
    return [Field(c["name"], c["type"]) for c in sorted(columns, key=lambda c: c["place"])]
