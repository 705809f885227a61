"""Words cut by ASCII white space, and token ids of words kept from text to text."""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

ENDS = b".,;:!?"


def texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return column.cast(pa.large_binary()).to_pylist()


class WordCache:
    """What `make(words)` gives for words, kept from text to text.

    Words met lately are kept: at most `limit` of them and those of one text in either of two generations, so memory stays bounded however
    many different words there are.
    """

    def __init__(self, make: Callable[[list[bytes]], list], limit: int = 300_000):
        self.make, self.limit = make, limit
        self.new: dict = {}
        self.old: dict = {}

    def of(self, words: list[bytes]) -> list:
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        if missing := set(words).difference(new):
            known = [w for w in missing if w in old]
            new.update(zip(known, map(old.__getitem__, known)))
            missing.difference_update(known)
            missing = list(missing)
            new.update(zip(missing, self.make(missing) if missing else ()))
        return list(map(new.__getitem__, words))


def packed_ids(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def bpe_words(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Packed ids of words by a byte-level BPE tokenizer file that lower-cases, drops white space and splits letters from the rest.

    White space ends a piece in such a tokenizer, so a text's ids are those of its words in a row. A word of letters alone passes the normaliser and splitter as
    one piece; its model is then asked directly, which is several times faster. Ends of `.,;:!?` after a letter are pieces of their own.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    shown = _byte_letters(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
    punctuation: dict[str, list[int]] = {}

    def plain(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    def one(word: bytes) -> list[int]:
        core = word.rstrip(ENDS)
        text = core.decode("utf-8", "replace")
        if not text[-1:].isalpha():
            return plain(word.decode("utf-8", "replace"))
        ids = None
        if text.isalpha() and text.isascii():
            ids = [t.id for t in model.tokenize(text.lower())]
        elif text.isalpha() and (lower := unicodedata.normalize("NFC", text).lower()).isalpha() and not any(c in text for c in "ΣİÅ"):
            ids = [t.id for t in model.tokenize(lower.encode().decode("latin-1").translate(shown))]
        if ids is None:
            return plain(word.decode("utf-8", "replace"))
        end = word[len(core) :].decode()
        if end:
            if end not in punctuation:
                if len(punctuation) > 10_000:
                    punctuation.clear()
                punctuation[end] = plain(end)
            ids = ids + punctuation[end]
        return ids

    return lambda words: [packed_ids(one(w)) for w in words]


def _byte_letters(byte_level) -> dict[int, str]:
    """The letter that stands for each byte, read off the pre-tokenizer itself."""
    table = {}
    for c in (chr(n) for n in range(1, 0x800)):
        raw, seen = c.encode(), byte_level.pre_tokenize_str(c)[0][0]
        table.update(zip(raw, seen))
    for c in ("ࠀ", " ", "￿", "\U00010000", "\U0010ffff") + tuple(chr(0x1000 * n) for n in range(1, 16) if n != 13) + tuple(
        chr(0x40000 * n) for n in range(1, 5)
    ):
        raw, seen = c.encode(), byte_level.pre_tokenize_str(c)[0][0]
        table.update(zip(raw, seen))
    return table


def first_places(words: list[bytes]) -> np.ndarray:
    """For each word the place where it first stands in the list: equal numbers for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter(map(seen.setdefault, words, range(len(words))), np.int64, len(words))


def repeated_windows(words: list[bytes], width: int) -> int:
    """Words in windows of `width` words that the list holds at least twice."""
    n = len(words)
    if n <= width:
        return 0
    codes = first_places(words)
    keys, span = codes, 1
    while span < width:
        step = min(span, width - span)
        _, ranks = np.unique(keys, return_inverse=True)
        keys = ranks[: len(ranks) - step].astype(np.int64) * n + ranks[step:]
        span += step
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[where] > 1)
    if not len(again):
        return 0
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, again, 1)
    np.add.at(marks, again + width, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def batches(of: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Record batches with their `text` as bytes."""
    for batch in of:
        yield batch, texts(batch.column("text"))
