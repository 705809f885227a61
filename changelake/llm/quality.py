"""Quality rules: word and line counts, and how well public vocabularies cover a text."""

from __future__ import annotations

import base64
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import saved
from changelake.llm.tokens import WordCache, batches, packed_ids, repeated_windows

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, " \
    "script string, lang string, n_tokens long, chars_per_token double, byte_share double, entropy double, wide_chars_per_token double, source string"

#: How far beyond the quartiles of its language and script a measure may lie, in ranges between the quartiles, and the least distance.
BANDS = {
    "chars_per_token": (6.0, 0.9), "wide_chars_per_token": (6.0, 0.9), "byte_share": (6.0, 0.1), "entropy": (6.0, 0.15),
}
#: Shorter texts say less about a vocabulary: bands come from texts of so many tokens, and are wider for shorter ones.
LEAST_TOKENS = 64
#: A language and script has a band of its own with so many of these texts, and so much of the language in the mean over its sources.
LEAST_ROWS, LEAST_SHARE = 200, 0.1
#: What no band allows, by script (None: all scripts). Vocabularies may spell other scripts than these in bytes.
LIMITS = {
    None: {"entropy": 0.1},
    "LATIN": {"chars_per_token": 1.0, "wide_chars_per_token": 1.0, "byte_share": 0.5},
    "NONE": {"chars_per_token": 1.0, "wide_chars_per_token": 1.0, "byte_share": 0.5},
}


@cache
def _vocabularies(piece_path: str, wide_path: str, wide_pattern: str):
    """Packed piece ids and number of wide tokens of words, and which pieces are single bytes."""
    import sentencepiece
    import tiktoken

    model = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    with open(wide_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    wide = tiktoken.Encoding("public", pat_str=wide_pattern, mergeable_ranks=ranks, special_tokens={})

    def make(words: list[bytes]) -> list[tuple[bytes, int]]:
        texts = [w.decode("utf-8", "replace") for w in words]
        ids = model.encode(texts, num_threads=1)
        return [(packed_ids(i), len(wide.encode_ordinary(" " + t))) for i, t in zip(ids, texts)]

    return WordCache(make), is_byte


def _script(text: str) -> str:
    """The script of most letters among at most the distinct ones, by the first word of their Unicode names."""
    if text.isascii():
        return "LATIN" if any(c.isalpha() for c in set(text)) else "NONE"
    counts: dict[str, int] = {}
    for c in set(text):
        if c.isalpha():
            name = unicodedata.name(c, "OTHER").split(" ")[0]
            counts[name] = counts.get(name, 0) + text.count(c)
    return max(sorted(counts), key=counts.get) if counts else "NONE"


def _measured(doc_id, raw: bytes, lang, source, vocabularies, is_byte) -> dict:
    words = raw.split()
    n = len(words)
    text = raw.decode("utf-8", "replace")
    lines = [x for x in raw.split(b"\n") if x.split()]
    repeats = repeated_windows(words, 5)
    packed, wide_counts = zip(*vocabularies.of(words)) if words else ((), ())
    ids, wide_tokens = np.frombuffer(b"".join(packed), dtype="<u4"), sum(wide_counts)
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
    counts = np.bincount(ids)
    counts = counts[counts > 0]
    tokens = len(ids)
    entropy = float(-(counts / tokens * np.log2(counts / tokens)).sum() / np.log2(tokens)) if tokens > 1 else 0.0
    return {
        "doc_id": doc_id, "n_words": n, "word_chars": chars, "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeats,
        "base_failed": n < 10 or 100 * repeats > 20 * n, "script": _script(text), "lang": lang, "n_tokens": tokens,
        "chars_per_token": chars / tokens if tokens else 0.0,
        "byte_share": float(is_byte[ids].mean()) if tokens else 0.0, "entropy": entropy,
        "wide_chars_per_token": chars / wide_tokens if wide_tokens else 0.0, "source": source,
    }


def measures(docs: DataFrame, piece_path: str, wide_path: str, wide_pattern: str) -> DataFrame:
    """The base counts and the vocabulary measures of every whole text, with one row per document."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(MEASURES))

    def run(of):
        vocabularies, is_byte = _vocabularies(piece_path, wide_path, wide_pattern)
        for batch, raws in batches(of):
            rows = [
                _measured(d, raw or b"", lang, source, vocabularies, is_byte)
                for d, raw, lang, source in zip(
                    batch.column("doc_id").to_pylist(), raws, batch.column("lang").to_pylist(), batch.column("source").to_pylist()
                )
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select("doc_id", "text", "lang", "source").mapInArrow(run, MEASURES)


def _band(units: DataFrame, *keys: str) -> DataFrame:
    """For each measure the middle and half the range between the quartiles, as the median over sources has them.

    Where the sources' middles lie further apart, half the range is that between them.
    """
    def band(m: str):
        low = m != "byte_share"
        mid, half = F.get(m, F.lit(1)), F.get(m, F.lit(2)) - F.get(m, F.lit(1)) if low else F.get(m, F.lit(1)) - F.get(m, F.lit(0))
        apart = F.abs(F.percentile(mid, F.lit(0.75 if low else 0.25)) - F.percentile(mid, F.lit(0.5)))
        return F.struct(F.percentile(mid, F.lit(0.5)).alias("mid"), F.greatest(F.percentile(half, F.lit(0.5)), apart).alias("half")).alias(m)

    return units.groupBy(*keys).agg(*(band(m) for m in BANDS), F.sum("_n").alias("_rows"))


def bands(measured: DataFrame) -> DataFrame:
    """`_band` for every _lang and _script of the texts: their own, else that of the script, of the language or of all; null where no text is long enough.

    Quartiles are taken in each source and their medians over sources count, so a source weighs the same however many rows it has. Of the quartiles
    only the middle and the one on the good side count: what is bad in a source, below half of it, moves them little. A group has a band of its own if it
    has LEAST_ROWS texts and, in the mean over the sources of its language, LEAST_SHARE of them; texts without letters never have. The bands of
    scripts, languages and of all come from groups that have one (if none has, from all).
    """
    long_enough = measured.where(F.col("n_tokens") >= LEAST_TOKENS)
    quartiles = (F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(m) for m in BANDS)
    units = saved(long_enough.groupBy("_lang", "_script", "source").agg(F.count("*").alias("_n"), *quartiles), "quality-units")
    of_source = units.groupBy("_lang", "source").agg(F.sum("_n").alias("_all"))
    sources = of_source.groupBy("_lang").agg(F.count("*").alias("_sources"))
    shares = (
        units.select("_lang", "_script", "source", "_n").join(of_source.toDF("_l", "_s", "_all"), F.col("_lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")))
        .groupBy("_lang", "_script").agg(F.sum("_n").alias("_rows"), F.sum(F.col("_n") / F.col("_all")).alias("_share"))
        .join(sources, "_lang")
    )
    own = shares.where((F.col("_rows") >= LEAST_ROWS) & (F.col("_share") >= LEAST_SHARE * F.col("_sources")) & (F.col("_script") != "NONE"))
    own = saved(own.select("_lang", "_script"), "quality-groups")
    trusted = units.join(own, ["_lang", "_script"], "left_semi")
    packed = lambda df, name, *keys: df.select(*keys, F.struct(*BANDS).alias(name))
    of_all = _band(units if own.isEmpty() else trusted).where("_rows is not null")
    return saved(
        measured.select("_lang", "_script").distinct()
        .join(packed(_band(trusted, "_lang", "_script"), "_own", "_lang", "_script"), ["_lang", "_script"], "left")
        .join(packed(_band(trusted, "_script"), "_of_script", "_script"), "_script", "left")
        .join(packed(_band(trusted, "_lang"), "_of_lang", "_lang"), "_lang", "left")
        .join(packed(of_all, "_of_all"), F.lit(True), "left")
        .select("_lang", "_script", F.coalesce("_own", "_of_script", "_of_lang", "_of_all").alias("_band")),
        "bands",
    )


def judge(measured: DataFrame) -> DataFrame:
    """`kept`: not base_failed, and inside the bands of the text's language and script and the limits of its script.

    A band ends, on the bad side, so many ranges between the quartiles beyond the quartile (BANDS), never less than its least distance. Characters per
    token and entropy may not fall below, byte share may not rise above. For a text of fewer than LEAST_TOKENS tokens
    the distance grows with the root of what it lacks. A null language is a group like any other, so is a null source.
    """
    measured = measured.withColumns({"_lang": F.coalesce("lang", F.lit("und")), "_script": F.coalesce("script", F.lit("NONE"))})
    joined = measured.join(bands(measured), ["_lang", "_script"], "left")
    wider = F.sqrt(F.greatest(F.lit(1.0), F.lit(float(LEAST_TOKENS)) / F.greatest("n_tokens", F.lit(1))))

    def inside(m: str):
        ranges, least = BANDS[m]
        mid, half = F.col(f"_band.{m}.mid"), F.col(f"_band.{m}.half")
        reach = half + F.greatest(2 * half * ranges, F.lit(least)) * wider
        good = F.coalesce(F.col(m) <= mid + reach if m == "byte_share" else F.col(m) >= mid - reach, F.lit(True))
        for script, limits in LIMITS.items():
            if m in limits:
                within = F.col(m) <= limits[m] if m == "byte_share" else F.col(m) >= limits[m]
                good &= within if script is None else (F.col("_script") != script) | within
        return good

    fine = inside("chars_per_token") & inside("wide_chars_per_token") & inside("byte_share") & inside("entropy")
    return joined.withColumn("kept", ~F.col("base_failed") & fine).drop("_lang", "_script", "_band", "source")


def rate(docs: DataFrame, piece_path: str, wide_path: str, wide_pattern: str) -> DataFrame:
    """Measures and verdict of every document.

    Null texts count as empty: no words, base_failed, not kept. Repeated rows are judged each. Only doc_id, text, lang and
    source are read. An empty table gives no rows.
    """
    return judge(saved(measures(docs, piece_path, wide_path, wide_pattern), "quality"))
