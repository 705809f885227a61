"""Language-model scores: a log-bilinear model over the two words before, trained with noise-contrastive estimation."""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import remainder, saved
from changelake.llm.tokens import batches

#: Outputs of the model: the most frequent words, classes that all other words are hashed to by their ends, and the end of a text.
WORDS, CLASSES = 1535, 512
ENDING = 3
OUTPUTS = WORDS + CLASSES + 1
END, BEGIN = OUTPUTS - 1, OUTPUTS
#: Frequent words that tasks hold with their counts: at most so many; the others are looked up by a join.
HEAD = 1 << 18
DIM, NOISE, BATCH, RATE, ROUNDS, SEED = 16, 48, 1536, 0.4, 2, 13
#: Parameter sets that one task adds up.
FAN_IN = 8


def tokens(raw: bytes | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased; the end is not among them."""
    return (raw or b"").lower().split()


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % CLASSES


def counted(docs: DataFrame) -> DataFrame:
    """(word, class, c) over all given texts. A task adds up its own words before they are shuffled, in portions of bounded size."""

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch() -> pa.RecordBatch:
            words = list(counts)
            columns = [pa.array(words, pa.binary()), pa.array([class_of(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "class", "c"])

        for _, raws in batches(of):
            for raw in raws:
                counts.update(tokens(raw))
                if len(counts) > 500_000:
                    yield batch()
                    counts.clear()
        if counts:
            yield batch()

    found = docs.select("text").mapInArrow(run, "word binary, class int, c long")
    return saved(found.groupBy("word", "class").agg(F.sum("c").alias("c")), "lm-words")


@dataclass
class Vocabulary:
    """What tasks know of the words: those of the head with their counts, and the counts of all.

    A word of the model is an output itself. Any other word w is reached through its class: P(w) = P(class) * (c + 1) / (class's count + class's words + 1), where
    the last 1 stands for all words not seen in training; so the chances of all tokens add up to 1.
    """

    words: list[bytes]
    counts: np.ndarray
    outputs: np.ndarray
    class_sizes: np.ndarray
    class_words: np.ndarray
    n: int
    v: int
    ends: int
    place: dict[bytes, int] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"place": {}}

    def places(self) -> dict[bytes, int]:
        if not self.place:
            self.place = dict(zip(self.words, range(len(self.words))))
        return self.place

    def unigrams(self) -> np.ndarray:
        """Chances of the outputs by their counts in training; those not seen count half."""
        found = np.zeros(OUTPUTS)
        own = self.outputs < WORDS
        found[self.outputs[own]] = self.counts[own]
        found[WORDS:END] = self.class_sizes
        found[END] = self.ends
        found = np.maximum(found, 0.5)
        return found / found.sum()

    def class_logs(self) -> np.ndarray:
        return np.log10(self.class_sizes + self.class_words + 1.0)


def vocabulary(words: DataFrame, ends: int) -> Vocabulary:
    """From all counts: the head are the most frequent words, cut where counts, rounded to six binary digits, still leave HEAD words at most."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.col("c"))) - 5, F.lit(0)))
    level = (F.floor(F.col("c") / step) * step).cast("long")
    words = words.withColumn("level", level)
    # One row for each of some thousand rounded counts at most.
    levels = sorted(((r.level, r.k, r.c) for r in words.groupBy("level").agg(F.count("*").alias("k"), F.sum("c").alias("c")).collect()), reverse=True)
    least, room = None, HEAD
    for lev, k, _ in levels:
        if k > room:
            break
        least, room = lev, room - k
    head = [] if least is None else words.where(F.col("level") >= least).select("word", "class", "c").collect()
    head.sort(key=lambda r: (-r.c, bytes(r.word)))
    sizes, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in words.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("k")).collect():
        sizes[r["class"]], distinct[r["class"]] = r.c, r.k
    for r in head[:WORDS]:
        sizes[r["class"]] -= r.c
        distinct[r["class"]] -= 1
    outputs = np.array([i if i < WORDS else WORDS + r["class"] for i, r in enumerate(head)], np.int64)
    total = sum(c for _, _, c in levels) + ends
    kinds = sum(k for _, k, _ in levels) + (ends > 0)
    return Vocabulary([bytes(r.word) for r in head], np.array([r.c for r in head], float), outputs, sizes, distinct, total, kinds, ends)


ENCODED = "doc_id long, held_out boolean, ids binary, n_tokens long, n_known long, base double, inside double, tail array<struct<word:binary,n:long>>"


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per text: its outputs as 16-bit numbers, sums over its head words, and its other words with their counts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ENCODED))
    end_log = math.log10(vocab.ends + 1)

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, logs, class_logs = vocab.places().get, np.log10(vocab.counts + 1), vocab.class_logs()
        outside = vocab.outputs >= WORDS
        inside = np.where(outside, logs - class_logs[np.clip(vocab.outputs - WORDS, 0, CLASSES - 1)], 0.0) if len(logs) else logs
        for batch, raws in batches(of):
            rows = []
            for doc_id, held_out, raw in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), raws):
                words = tokens(raw)
                at = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                known = at[at >= 0]
                ids = np.full(len(words) + 1, END, "<u2")
                ids[:-1][at >= 0] = vocab.outputs[known]
                missing = np.flatnonzero(at < 0)
                rest = [words[i] for i in missing.tolist()]
                classes = np.array([class_of(w) for w in rest], np.int64)
                ids[missing] = WORDS + classes
                rows.append(
                    {
                        "doc_id": doc_id, "held_out": held_out, "ids": ids.tobytes(), "n_tokens": len(words) + 1, "n_known": len(known) + (vocab.ends > 0),
                        "base": float(logs[known].sum()) + end_log - (len(words) + 1) * math.log10(vocab.n + vocab.v + 1),
                        "inside": float(inside[known].sum() - class_logs[classes].sum()), "tail": [{"word": w, "n": n} for w, n in Counter(rest).items()],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select("doc_id", "text", (remainder(F.col("doc_id"), 7) == 2).alias("held_out")).mapInArrow(run, ENCODED)


@dataclass
class Model:
    """log P(w | a, b) = (left[a] + right[b]) . targets[w] + bias[w] - log Z(a, b), a and b being the outputs two places and one place before."""

    left: np.ndarray
    right: np.ndarray
    targets: np.ndarray
    bias: np.ndarray
    key: str = ""

    def parts(self) -> list[np.ndarray]:
        return [self.left, self.right, self.targets, self.bias]

    def log_z(self) -> np.ndarray:
        """log Z of all pairs of words before: the sum over w of exp(left[a] . w + bias) * exp(right[b] . w) is one product of two matrices."""
        one = self.left @ self.targets.T + self.bias
        two = self.right @ self.targets.T
        top, top2 = one.max(1), two.max(1)
        z = np.exp(one - top[:, None]) @ np.exp(two - top2[:, None]).T
        return np.log(z) + top[:, None] + top2[None, :]

    def logs(self, ids: np.ndarray, log_z: np.ndarray) -> np.ndarray:
        """Natural logarithms of the chances of a text's outputs in a row."""
        a, b = before(ids)
        found = np.einsum("ij,ij->i", self.left[a] + self.right[b], self.targets[ids])
        return found + self.bias[ids] - log_z[a, b]


def before(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begun = np.concatenate([np.full(2, BEGIN, np.int64), ids])
    return begun[:-2], begun[1:-1]


def start(unigrams: np.ndarray) -> Model:
    """A model that says what the counts say."""
    random = np.random.default_rng(SEED)
    small = lambda n: random.normal(0, 0.1, (n, DIM))
    return Model(small(OUTPUTS + 1), small(OUTPUTS + 1), small(OUTPUTS), np.log(unigrams))


def _added(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows and the sums of their values."""
    rows = rows.astype(np.uint16)
    order = np.argsort(rows, kind="stable")  # by digits, as the numbers are short
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(values.take(order, axis=0), first, axis=0)


class Trainer:
    """Noise-contrastive estimation by Adagrad: tokens are told from NOISE words drawn by the unigram chances, which all tokens of a step share."""

    def __init__(self, model: Model, unigrams: np.ndarray, seed: int):
        self.model = Model(*(p.astype(np.float32) for p in model.parts()))
        self.random = np.random.default_rng(seed)
        self.ends = np.cumsum(unigrams)
        self.noise_logs = np.log(NOISE * unigrams).astype(np.float32)
        self.squares = [np.full(p.shape, 1e-3, np.float32) for p in self.model.parts()]

    def _moved(self, part: int, rows: np.ndarray, grads: np.ndarray) -> None:
        rows, grads = _added(rows, grads)
        squares = self.squares[part][rows] + grads * grads
        self.squares[part][rows] = squares
        self.model.parts()[part][rows] += RATE * grads / np.sqrt(squares)

    def step(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> None:
        m, n = self.model, np.float32(len(w))
        drawn = np.minimum(np.searchsorted(self.ends, self.random.random(NOISE)), OUTPUTS - 1)
        context, own, others = m.left.take(a, axis=0) + m.right.take(b, axis=0), m.targets.take(w, axis=0), m.targets[drawn]
        up = np.einsum("ij,ij->i", context, own) + m.bias[w] - self.noise_logs[w]
        down = context @ others.T + (m.bias[drawn] - self.noise_logs[drawn])
        wrong = 1 / (1 + np.exp(np.clip(up, -30, 30)))  # how far tokens are from being told
        np.clip(down, -30, 30, out=down)
        taken = 1 / (1 + np.exp(np.negative(down, out=down), out=down))  # how far noise is taken for tokens
        slope = (wrong[:, None] * own - taken @ others) / n
        both = np.concatenate([w, drawn])
        self._moved(0, a, slope)
        self._moved(1, b, slope)
        self._moved(2, both, np.concatenate([wrong[:, None] * context, -(taken.T @ context)]) / n)
        self._moved(3, both, np.concatenate([wrong, -taken.sum(0)]) / n)


PARTS = "part int, weight double, data binary"


def _trained(rows: DataFrame, model: Model, unigrams: np.ndarray, seed: int) -> DataFrame:
    """The parameters that each task reaches over all its texts, times its number of tokens; one row a task."""

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen, held = None, 0, []

        def steps(least: int) -> None:
            """All whole steps of what is held, and what is left if there is no more to come."""
            nonlocal held
            if sum(len(h) for h in held) < least or not held:
                return
            pairs = [before(h) for h in held]
            a, b, w = (np.concatenate(x) for x in ([p[0] for p in pairs], [p[1] for p in pairs], held))
            order = trainer.random.permutation(len(w))
            for k in range(0, len(w), BATCH):
                at = order[k : k + BATCH]
                trainer.step(a[at], b[at], w[at])
            held = []

        for batch in of:
            for raw in batch.column("ids").to_pylist():
                if trainer is None:
                    trainer = Trainer(model, unigrams, seed)
                ids = np.frombuffer(raw, "<u2").astype(np.int64)
                seen += len(ids)
                held.append(ids)
                steps(64 * BATCH)
        if trainer is not None:
            steps(0)
            data = np.concatenate([p.ravel() for p in trainer.model.parts()]).astype(float) * seen
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([float(seen)]), pa.array([data.astype("<f8").tobytes()], pa.binary())], ["part", "weight", "data"])

    return rows.where(~F.col("held_out")).select("ids").mapInArrow(run, PARTS)


def _summed(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in of:
        for w, raw in zip(batch.column("weight").to_pylist(), batch.column("data").to_pylist()):
            data = np.frombuffer(raw, "<f8")
            total, weight = data.copy() if total is None else total + data, weight + w
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([weight]), pa.array([total.tobytes()], pa.binary())], ["part", "weight", "data"])


def _average(sets: DataFrame) -> Model | None:
    """The mean of parameter sets by weight, added up FAN_IN at a time; one set comes to the driver."""
    sets = saved(sets, "lm-sets")
    while (n := sets.count()) > 1:
        sets = saved(sets.repartition(-(-n // FAN_IN)).mapInArrow(_summed, PARTS), "lm-sets")
    row = sets.first()
    if row is None:
        return None
    data, at, parts = np.frombuffer(row.data, "<f8") / row.weight, 0, []
    for shape in ((OUTPUTS + 1, DIM), (OUTPUTS + 1, DIM), (OUTPUTS, DIM), (OUTPUTS,)):
        size = math.prod(shape)
        parts.append(data[at : at + size].reshape(shape).copy())
        at += size
    return Model(*parts)


def fit(rows: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Model:
    """A model from all rows (see `encoded`) that are not held out.

    In each round every task goes over all its texts from the same parameters; these are then averaged by tokens. Without a row it stays with the counts.
    """
    unigrams = vocab.unigrams()
    model = start(unigrams)
    for i in range(rounds):
        model = _average(_trained(rows, model, unigrams, SEED + i)) or model
    model.key = uuid.uuid4().hex
    return model


_LOG_Z: dict[str, np.ndarray] = {}


def _log_z(model: Model) -> np.ndarray:
    """The table of a model, made once in a Python worker."""
    if model.key not in _LOG_Z:
        _LOG_Z.clear()
        _LOG_Z[model.key] = model.log_z()
    return _LOG_Z[model.key]


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with `model`: log10 of the chances of all outputs of the text."""

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _log_z(model)
        for batch in of:
            found = [float(model.logs(np.frombuffer(raw, "<u2").astype(np.int64), table).sum() / math.log(10)) for raw in batch.column("ids").to_pylist()]
            kept = [batch.column(c) for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.float64())], [c for c in batch.schema.names if c != "ids"] + ["model"])

    out = rows.drop("tail")
    schema = ", ".join(f"{c} {t}" for c, t in out.dtypes if c != "ids")
    return out.mapInArrow(run, f"{schema}, model double")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Counts, classes and the model come from all texts whose id's crc32 modulo 7 isn't 2; a null id counts as the empty text there. Null texts count as empty: their one token is the end. Words that
    are too rare for the head are looked up by a join. Repeated rows are counted, trained on and scored each. Words of equal count take their places bytewise. Very long texts are
    read whole. Of other columns nothing is read. An empty table gives no rows; without training texts all counts are 0.
    """
    training = docs.where(remainder(F.col("doc_id"), 7) != 2)
    words = counted(training)
    vocab = vocabulary(words, training.count())
    rows = saved(encoded(docs, vocab).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    model = fit(rows, vocab)
    tail = rows.select("row", F.inline("tail").alias("word", "n")).join(words.select("word", "c"), "word", "left")
    count = F.coalesce("c", F.lit(0))
    tail = tail.groupBy("row").agg(F.sum(F.col("n") * F.log10(count + 1)).alias("tail_log"), F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("tail_known"))
    found = scored(rows, model).join(tail, "row", "left")
    more = F.coalesce("tail_log", F.lit(0.0))
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + F.col("inside") + more).alias("score"),
    )
