"""Log positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_lsn(lsn: Column) -> Column:
    """Position `X/Y` (two hexadecimal words) as one ordered number; null if it is malformed."""
    words = F.split(lsn, "/")
    high = F.conv(F.get(words, F.lit(0)), 16, 10).cast("bigint")
    low = F.conv(F.get(words, F.lit(1)), 16, 10).cast("bigint")
    position = F.try_add(F.try_multiply(high, F.lit(4294967296)), low)
    return F.when(lsn.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), position)


def format_lsn(position: Column) -> Column:
    """The text form of a position."""
    high = F.hex(F.shiftrightunsigned(position, 32))
    low = F.hex(position.bitwiseAND(F.lit(4294967295)))
    return F.concat_ws("/", high, low)
