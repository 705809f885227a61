"""Packing of token sequences: a configuration linear program over the lengths, rounded and filled best-fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.llm.common import saved
from changelake.llm.tokens import WordCache, batches, bpe_words

CAPACITY, END = 4096, 1
#: Rounds of the multiplicative weights, and how fast they move.
ROUNDS, RATE = 24, 0.5
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def _words(path: str) -> WordCache:
    return WordCache(bpe_words(path))


def token_bytes(raw: bytes | None, words: WordCache) -> bytes:
    """Little-endian 32-bit ids of a text and of the end mark."""
    return b"".join(words.of((raw or b"").lower().split())) + np.array([END], "<u4").tobytes()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents' ids cut into pieces of `capacity` at most: doc_id, piece, start, length, ids_crc32. A null text counts as empty."""

    def run(of):
        words = _words(path)
        for batch, raws in batches(of):
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), raws):
                ids = token_bytes(raw, words)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def priced(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of a sequence of each size up to `capacity`, and the last length put into it (0: left empty); values[l] for length l."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        options = best[c - 1 :: -1] + values[1 : c + 1]
        k = int(options.argmax())
        if options[k] > best[c - 1]:
            best[c], last[c] = options[k], k + 1
        else:
            best[c] = best[c - 1]
    return best, last


def _filled(last: np.ndarray, room: int) -> dict[int, int]:
    config: dict[int, int] = {}
    while room > 0:
        if (length := int(last[room])) == 0:
            room -= 1
            continue
        config[length] = config.get(length, 0) + 1
        room -= length
    return config


def fractional(demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often to use them, so that all lengths are about covered: the configuration program.

    Lengths carry weights, which start at their share of a sequence. In each round a knapsack program prices all sequences at these weights; every length
    proposes the best sequence that holds it, and the round spends an equal share of the demand on the proposals, dearest first. Then the weights of lengths
    covered less than others grow and the rest shrink by a factor: multiplicative weights.
    """
    lengths = np.flatnonzero(demand[: capacity + 1])
    weights = np.zeros(capacity + 1)
    weights[lengths] = lengths / capacity
    covered = np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    for _ in range(ROUNDS if len(lengths) else 0):
        values = np.full(capacity + 1, -np.inf)
        values[lengths] = weights[lengths]
        best, last = priced(values, capacity)
        worth = {int(x): weights[x] + best[capacity - x] for x in lengths}
        left = demand / ROUNDS
        for x in sorted(worth, key=lambda x: (-worth[x], -x)):
            if left[x] <= 0:
                continue
            config = _filled(last, capacity - x)
            config[x] = config.get(x, 0) + 1
            amount = min(max(left[k], 0.0) / a for k, a in config.items())
            if amount <= 0:
                continue
            key = tuple(sorted(config.items()))
            used[key] = used.get(key, 0.0) + amount
            for k, a in config.items():
                left[k] -= amount * a
                covered[k] += amount * a
        share = covered[lengths] / demand[lengths]
        weights[lengths] *= np.exp(RATE * (share.mean() - share) * ROUNDS / max(share.max() * ROUNDS, 1e-9))
    return [(dict(k), x) for k, x in sorted(used.items(), key=lambda item: (-sum(a * b for a, b in item[0]), item[0]))]


class Packed:
    """Groups of equal sequences: how many, and the lengths in each in order with their numbers."""

    def __init__(self) -> None:
        self.groups: list[tuple[int, list[tuple[int, int]]]] = []

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.groups)


def _unwound(content) -> list[tuple[int, int]]:
    out = []
    while content:
        out.append(content[:2])
        content = content[2]
    return out[::-1]


def pack(demand: np.ndarray, capacity: int = CAPACITY) -> Packed:
    """All lengths in sequences: the program rounded down, then the rest best-fit, longest first, into the room that is left.

    Everything is counted by length, never by item, so the work is bounded by the capacity however many documents there are. Of three roundings (all, half, a
    tenth of what the program says) the one with the fewest sequences is kept.
    """
    program = fractional(demand, capacity)
    return min((_rounded(demand, capacity, program, part) for part in (1.0, 0.5, 0.1)), key=lambda p: p.sequences)


def _rounded(demand: np.ndarray, capacity: int, program, part: float) -> Packed:
    left = demand.astype(np.int64).copy()
    rooms: dict[int, list] = {}  # room -> [(number, content)]
    order: list[int] = []

    def put(room: int, n: int, content) -> None:
        if n:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((n, content))

    for config, amount in program:
        n = min(int(amount * part), *(int(left[k]) // a for k, a in config.items()))
        if n <= 0:
            continue
        content = None
        for k, a in sorted(config.items(), reverse=True):
            left[k] -= n * a
            content = (k, a, content)
        put(capacity - sum(k * a for k, a in config.items()), n, content)
    for length in np.flatnonzero(left)[::-1]:
        length, n = int(length), int(left[length])
        while n:
            at = bisect_left(order, length)
            if at < len(order):
                room = order[at]
                have, content = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            else:
                room, have, content = capacity, n, None
            each = min(room // length, n)
            take = min(have, n // each)
            if content is None and room == capacity:
                have = take
            put(room - each * length, take, (length, each, content))
            put(room, have - take, content)
            n -= each * take
    out = Packed()
    for room in order:
        out.groups += [(n, _unwound(content)) for n, content in rooms[room]]
    return out


def places(packed: Packed) -> tuple[np.ndarray, ...]:
    """For the items of each length in a row: key (length, first rank), first sequence, items of it in a sequence, and where they begin there."""
    rows, ranks, base = [], {}, 0
    for n, content in packed.groups:
        at = 0
        for length, each in content:
            first = ranks.get(length, 0)
            rows.append((length << 44 | first, base, each, at, first, length))
            ranks[length] = first + n * each
            at += length * each
        base += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(6))


ROW = PIECES + ", sequence_id long, offset long"


def assign(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset.

    The histogram of lengths (one row per length, so `capacity` rows at most) goes to the driver, which packs it. The pieces of a length are numbered in
    salted shares, whose sizes are added up, so a length that most pieces have is numbered by many tasks; a
    number is looked up in the table of places, whose size depends on the capacity alone.
    """
    rows = saved(rows.withColumn("_id", F.monotonically_increasing_id()), "pieces")
    demand = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect():
        demand[r["length"]] = r["n"]
    table = places(pack(demand, capacity))
    salts = int(max(64, demand.sum() // 1_000_000))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
    shares = rows.groupBy("length", "_salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shares = saved(shares.select("length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")), "piece-shares")
    number = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_id"))
    ranked = rows.withColumn("_n", number.cast("long")).join(shares, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_n") - 1)

    def run(of):
        key, base, each, begins, first, _ = table
        for batch in of:
            length, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "_rank"))
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            inside = rank - first[at]
            got = [pa.array(base[at] + inside // each[at]), pa.array(begins[at] + inside % each[at] * length)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *got], names=[*names, "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(run, ROW)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces and where they lie in sequences of `capacity` tokens.

    Null texts count as empty: one piece that is the end mark. Repeated rows are packed each. Ids may be null or repeat. Columns but doc_id and
    text are not read. An empty table gives no rows.
    """
    return assign(pieces(docs, path, capacity), capacity)
