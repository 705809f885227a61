"""Regular-expression spans with code-point positions, in generated and built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelake.llm.common import let

#: Running sums are taken within blocks of this many numbers and over the blocks, so that many hits in one text stay cheap.
BLOCK = 64
#: Characters kept on either side of a hit.
AROUND = 48

HIT = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _running(numbers: Column) -> Column:
    """For each number, the sum of those before it."""

    def sums(part: Column, first: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(first.cast("int").alias("t"), F.array().cast("array<int>").alias("all")),
            lambda a, x: F.struct((a["t"] + x).cast("int").alias("t"), F.concat(a["all"], F.array(a["t"])).alias("all")),
            lambda a: a["all"],
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK)),
    )
    return let(
        blocks,
        lambda bs: let(
            sums(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x)), F.lit(0)),
            lambda firsts: F.flatten(F.transform(bs, lambda b, i: sums(b, F.get(firsts, i)))),
        ),
    )


def hits(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches of a pattern that never matches the empty text.

    The text is cut at the matches: a match starts where the pieces and matches before it end.
    """

    def placed(found: Column, pieces: Column) -> Column:
        lengths = F.transform(found, lambda v, i: F.length(F.get(pieces, i)) + F.length(v))
        return let(
            _running(lengths),
            lambda firsts: F.transform(
                found,
                lambda v, i: F.struct(
                    (F.get(firsts, i) + F.length(F.get(pieces, i))).cast("int").alias("start"),
                    (F.get(firsts, i) + F.length(F.get(pieces, i)) + F.length(v)).cast("int").alias("end"),
                    v.alias("value"),
                    F.right(F.get(pieces, i), F.lit(AROUND)).alias("before"),
                    F.left(F.get(pieces, i + 1), F.lit(AROUND)).alias("after"),
                ),
            ),
        )

    none = F.array().cast(HIT)
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) <= 0, none).otherwise(
            let(F.split(text, pattern, -1), lambda pieces: placed(found, pieces))
        ),
    )


def named(spans: Column, kind: str) -> Column:
    """Texts kind:start:end."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def last_words(before: Column) -> Column:
    """The words of a piece, lower-cased, nearest to its end first; the first of them may be cut."""
    plain = F.lower(F.trim(F.translate(before, "\t\n\x0b\x0c\r", "     ")))
    return F.reverse(F.filter(F.split(plain, " ", -1), lambda w: w != ""))


def first_words(after: Column) -> Column:
    plain = F.lower(F.trim(F.translate(after, "\t\n\x0b\x0c\r", "     ")))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")
