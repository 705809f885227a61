"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import remainder, sampled, saved
from changelake.llm.tokens import batches

#: Places that terms are hashed to.
PLACES = 1 << 20
#: Bounds of the training set: rows drawn of each class, and places that get weights.
PER_CLASS, ACTIVE = 3000, 2048
#: How much the toxic rows weigh together, against 1 for the others: one or two bad terms among many are enough then.
TOXIC_WEIGHT = 2.0
#: The most that a text without any weighted term scores.
NO_TERMS = 0.4
#: Least chi-square of a place that gets a weight, and rows that hold it.
CHI, LEAST_ROWS = 12.0, 4
FACTORS, EPOCHS, BATCH = 8, 60, 256
RATE, PENALTY, SEED = 0.02, 1e-2, 8
EDGES = b".,;:!?\"'()[]{}#*$%&|<>-_=+/\\~`^@"


def terms(raw: bytes | None) -> list[int]:
    """Places of the different words of a text, A-Z lower-cased, without punctuation at their ends."""
    return sorted({zlib.crc32(t) & (PLACES - 1) for w in set((raw or b"").lower().split()) if (t := w.strip(EDGES))})


class Model:
    """score = sigmoid(bias + sum w_i + sum over pairs <v_i, v_j>) over the terms that a text holds."""

    def __init__(self, places: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.places, self.bias, self.linear, self.factors = places, bias, linear, factors

    def rows(self) -> np.ndarray:
        """Place -> row of the weights, or -1."""
        table = np.full(PLACES, -1, np.int32)
        table[self.places] = np.arange(len(self.places))
        return table

    def score(self, rows: np.ndarray) -> float:
        v = self.factors[rows]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + float(self.linear[rows].sum()) + pairs, -30, 30))))


def _selected(docs: list[list[int]], labels: np.ndarray) -> np.ndarray:
    """The places that tell the classes apart best: by the chi-square of their presence, where it is CHI at least and they are in LEAST_ROWS rows."""
    flat = np.concatenate([np.array(d, np.int64) for d in docs]) if docs else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    seen = np.bincount(flat, minlength=PLACES)
    pos = np.bincount(flat, weights=labels[owner], minlength=PLACES)
    n, share = len(docs), labels.mean()
    chi = (pos - seen * share) ** 2 / np.maximum(seen * share * (1 - share) * (1 - seen / n), 1e-9)
    chi[seen < LEAST_ROWS] = 0
    order = np.lexsort((np.arange(PLACES), -chi))[:ACTIVE]
    return np.sort(order[chi[order] >= CHI])


def train(docs: list[list[int]], labels: list[int], weights: list[float]) -> Model:
    """Adam on the weighted logistic loss. The weights say what a row counts, whatever its class's share."""
    y, w = np.array(labels, float), np.array(weights, float)
    w = w / w.mean()
    places = _selected(docs, y)
    row_of = np.full(PLACES, -1, np.int64)
    row_of[places] = np.arange(len(places))
    data = [row_of[np.array(d, np.int64)] if d else np.zeros(0, np.int64) for d in docs]
    data = [d[d >= 0] for d in data]
    random = np.random.default_rng(SEED)
    prior = float(np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3))
    k = len(places)
    params = [np.array([np.log(prior / (1 - prior))]), np.zeros(k), random.normal(0, 0.02, (k, FACTORS))]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        for part in np.array_split(random.permutation(len(data)), max(1, len(data) // BATCH)):
            owner = np.repeat(np.arange(len(part)), [len(data[i]) for i in part])
            flat = np.concatenate([data[i] for i in part]) if len(part) else np.zeros(0, np.int64)
            v = params[2][flat]
            total = np.stack([np.bincount(owner, v[:, f], len(part)) for f in range(FACTORS)], 1) if k else np.zeros((len(part), FACTORS))
            squares = np.bincount(owner, (v**2).sum(1), len(part))
            z = params[0][0] + np.bincount(owner, params[1][flat], len(part)) + 0.5 * ((total**2).sum(1) - squares)
            error = w[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / max(len(part), 1)
            each = error[owner]
            slope = each[:, None] * (total[owner] - v)
            grads = [
                np.array([error.sum()]),
                np.bincount(flat, each, k) + PENALTY * params[1] / 10,
                (np.stack([np.bincount(flat, slope[:, f], k) for f in range(FACTORS)], 1) if k else slope[:0]) + PENALTY * params[2],
            ]
            t += 1
            for p, g, m, s in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    # A text without any of these terms gives no evidence, so it is never predicted toxic.
    return Model(places, min(float(params[0][0]), float(np.log(NO_TERMS / (1 - NO_TERMS)))), params[1], params[2])


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from labelled rows whose id's crc32 doesn't divide by 5; None without both classes.

    At most about PER_CLASS ids of each class are drawn, by hash, from all labelled ones; the places of their terms come to the driver
    as 32-bit numbers. Rows with a null label or null id are left out; if an id has several labels, toxic wins.
    """
    told = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    told = told.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # The ids are drawn before any text is touched. There are two classes, so the ids are about 2 * PER_CLASS at most: a broadcast spares the shuffle of texts.
    drawn_ids = saved(sampled(told, "toxic", PER_CLASS, F.col("doc_id")), "toxic-ids")
    chosen = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(drawn_ids), "doc_id")

    def run(of):
        for batch, raws in batches(of):
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "terms": pa.array([np.array(terms(raw), "<u4").tobytes() for raw in raws], pa.binary()),
                    "toxic": batch.column("toxic").cast(pa.int32()),
                }
            )

    # Rows that share an id count once.
    found = chosen.mapInArrow(run, "doc_id long, terms binary, toxic int").groupBy("doc_id", "toxic").agg(F.max("terms").alias("terms"))
    got = sorted((bytes(r.terms), r.toxic) for r in found.collect())
    if len({r[1] for r in got}) < 2:
        return None
    drawn = Counter(r[1] for r in got)
    weights = [(TOXIC_WEIGHT if r[1] else 1.0) / drawn[r[1]] for r in got]
    return train([np.frombuffer(r[0], "<u4").tolist() for r in got], [r[1] for r in got], weights)


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model | None, keep: bool = False) -> DataFrame:
    """Score of every whole text: doc_id, held_out, score, predicted (1 from 0.5 on); with `keep`, the rows of `docs` predicted 0.

    Null texts count as empty and get the model's bias; without a model all scores are 0. Repeated rows get the same score each. Of other columns nothing
    is read. An empty table gives no rows.
    """

    def values(raws, table):
        return [model.score(r[r >= 0]) if model else 0.0 for r in (table[np.array(terms(raw), np.int64)] for raw in raws)]

    def run(of):
        table = model.rows() if model else np.full(PLACES, -1, np.int32)
        for batch, raws in batches(of):
            got = np.array(values(raws, table), float)
            if keep:
                yield batch.filter(pa.array(got < 0.5))
            else:
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id").cast(pa.int64()), "held_out": batch.column("held_out"), "score": pa.array(got), "predicted": pa.array((got >= 0.5).astype(np.int32))}
                )

    if keep:
        return docs.mapInArrow(run, docs.schema)
    return docs.select("doc_id", "text", (remainder(F.col("doc_id"), 5) == 0).alias("held_out")).mapInArrow(run, SCORED)
