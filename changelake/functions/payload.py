"""JSON payloads to columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.casts import cast_text
from changelake.functions.types import Field


def parse_payload(payload: Column, fields: Iterable[Field]) -> Column:
    """Top-level JSON fields as a struct of text, parsed once for all fields.

    Everything is read as text because reading straight to numbers or booleans loses values
    such as "12" in quotes. The last of several equal keys counts.
    """
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    return F.from_json(payload, schema)


def typed_fields(parsed: Column, fields: Iterable[Field]) -> list[Column]:
    """The fields of `parse_payload` under their declared types."""
    return [cast_text(parsed.getField(f.name), f.type).alias(f.name) for f in fields]
