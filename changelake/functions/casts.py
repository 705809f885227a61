"""Text to typed values. A value that does not fit its type becomes null, never an error."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.types import SPARK_TYPES, Field, spark_type

# One element of a flat array literal: quoted, or bare up to the next comma.
ARRAY_ELEMENT = r'"(?:[^"\\]|\\.)*"|[^,"{}\s][^,"{}]*'
ARRAY_LITERAL = r'^\{(?:(?:' + ARRAY_ELEMENT + r')(?:,\s*(?:' + ARRAY_ELEMENT + r'))*)?\}$'


# Bounds just outside each integer type.
_OUTSIDE = {
    "INT32": (Decimal(-(2**31) - 1), Decimal(2**31)),
    "INT64": (Decimal(-(2**63) - 1), Decimal(2**63)),
}


def _integer(text: Column, canonical: str) -> Column:
    # By way of a decimal, so that 3.7 and 1e3 count. The bounds are tested instead of tried,
    # because a failing cast is slow.
    number = text.try_cast("decimal(38,18)")
    below, above = _OUTSIDE[canonical]
    return F.when((number > below) & (number < above), number.cast(SPARK_TYPES[canonical]))


def _boolean(text: Column) -> Column:
    return F.when(text.isNotNull(), F.lower(text).isin("true", "t"))


def _binary(text: Column) -> Column:
    escaped = F.try_to_binary(F.substring(text, 3, 2147483647), F.lit("hex"))
    return F.when(text.startswith("\\x"), escaped).otherwise(F.encode(text, "UTF-8"))


def _micros_of_day(text: Column) -> Column:
    """A time with a zone is brought to UTC; 24:00:00 is the end of the day."""
    zone = F.regexp_extract(text, r"\s*([+-][0-9]{1,2}(?::?[0-9]{2}){0,2}|[Zz])\s*$", 1)
    bare = F.regexp_replace(text, r"\s*(?:[+-][0-9]{1,2}(?::?[0-9]{2}){0,2}|[Zz])\s*$", "")
    clock = F.when(bare.contains(":"), F.concat(F.lit("1970-01-01 "), bare).try_cast("timestamp_ntz"))
    seconds = F.hour(clock) * 3600 + F.minute(clock) * 60
    micros = seconds.cast("bigint") * 1000000 + (F.date_part(F.lit("SECOND"), clock) * 1000000).cast("bigint")
    micros = F.when(bare.rlike(r"^\s*24:00(?::00(?:\.0*)?)?\s*$"), F.lit(86_400_000_000)).otherwise(micros)
    digits = F.rpad(F.regexp_replace(F.regexp_replace(zone, "^([+-])([0-9])(?![0-9])", "$10$2"), "[^0-9]", ""), 6, "0")
    part = lambda at: F.coalesce(F.substring(digits, at, 2).try_cast("bigint"), F.lit(0))
    ahead = (part(1) * 3600 + part(3) * 60 + part(5)) * F.when(zone.startswith("-"), -1_000_000).otherwise(1_000_000)
    return F.when(zone == "", micros).otherwise(F.pmod(micros - ahead, F.lit(86_400_000_000)))


def _array(text: Column) -> Column:
    elements = F.transform(
        F.regexp_extract_all(text, F.lit("(" + ARRAY_ELEMENT + ")"), F.lit(1)),
        lambda e: F.when(
            e.startswith('"'),
            F.regexp_replace(e.substr(F.lit(2), F.length(e) - 2), r"\\(.)", "$1"),
        ).when(F.upper(e) != "NULL", F.rtrim(e)),
    )
    return (
        F.when(text.startswith("["), F.from_json(text, SPARK_TYPES["ARRAY"]))
        .when(text.rlike(ARRAY_LITERAL), elements)
    )


def cast_text(text: Column, canonical: str) -> Column:
    """One text column as one canonical type."""
    if canonical in ("INT32", "INT64"):
        return _integer(text, canonical)
    if canonical == "BOOLEAN":
        return _boolean(text)
    if canonical == "BYTES":
        return _binary(text)
    if canonical == "TIME":
        return _micros_of_day(text)
    if canonical == "ARRAY":
        return _array(text)
    return text.try_cast(spark_type(canonical))


def cast_columns(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Cast the text columns named by `fields`; other columns pass through."""
    types = {f.name: f.type for f in fields}
    return df.select(
        [
            cast_text(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def conform(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Bring columns that already have a Spark type to their canonical type.

    Text goes through `cast_text`; a column that has the wanted type is left alone, so that a
    scan of a typed table stays a plain projection.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in fields:
        column, want = F.col(f"`{f.name}`"), spark_type(f.type)
        if have[f.name].typeName() == "string" and want.typeName() != "string":
            column = cast_text(column, f.type)
        elif have[f.name] != want:
            column = column.try_cast(want)
        out.append(column.alias(f.name))
    return df.select(out)
