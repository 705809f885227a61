"""Language identification by blended-spectrum string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import remainder, sampled
from changelake.llm.tokens import batches

#: Places of the n-gram presence vector; n-grams of 1 to LONGEST code points are hashed to them.
PLACES, LONGEST = 1 << 15, 3
#: Bounds of the training set: landmarks, and sampled rows of each language.
LANDMARKS, PER_LANGUAGE = 128, 250
RIDGE = 1e-3
#: Texts scored in one matrix product, and code points hashed at once.
ROWS, CHUNK = 64, 1 << 20


def _mark(row: np.ndarray, text: str) -> None:
    """Set the places of all n-grams of the text; long texts go in chunks that overlap."""
    for at in range(0, max(len(text), 1), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK + LONGEST - 1].encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint32)
        key = np.zeros(len(codes), np.uint32)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            key = key[: len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1 :]
            mixed = (key ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            row[(mixed >> np.uint32(17)).astype(np.intp)] = 1


def presence(texts: list[bytes | None]) -> np.ndarray:
    """A row of zeros and ones per text, lower-cased."""
    out = np.zeros((len(texts), PLACES), np.float32)
    for row, raw in zip(out, texts):
        if raw:
            _mark(row, raw.decode("utf-8", "replace").lower())
    return out


def has_letter(raw: bytes | None) -> bool:
    return bool(raw) and any(c.isalpha() for c in set(raw.decode("utf-8", "replace")))


class Model:
    """Landmarks (packed presence rows) and the weights of one regression per language."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.packed, self.weights = languages, np.packbits(landmarks.astype(bool), axis=1), weights

    def scores(self, rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
        return _kernel(rows, landmarks) @ self.weights

    def landmarks(self) -> np.ndarray:
        return np.unpackbits(self.packed, axis=1)[:, :PLACES].astype(np.float32)


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared n-grams over the geometric mean of their numbers."""
    sizes = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
    return (a @ b.T / sizes).astype(np.float64)


def train(rows: np.ndarray, labels: list[str]) -> Model:
    """Nyström features K(x, Z) K(Z, Z)^-1/2 and ridge regression on them, one against the rest.

    Landmarks are dealt round the languages in the order of the rows. Equal languages' ties go to the first in name order.
    """
    languages = sorted(set(labels))
    mine = {lang: [i for i, x in enumerate(labels) if x == lang] for lang in languages}
    turns = [mine[lang][k] for k in range(max(map(len, mine.values()))) for lang in languages if k < len(mine[lang])]
    landmarks = rows[turns[: max(LANDMARKS, len(languages))]]
    values, vectors = np.linalg.eigh(_kernel(landmarks, landmarks))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = np.vstack([_kernel(rows[i : i + 512], landmarks) for i in range(0, len(rows), 512)]) @ root
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Every language weighs the same however many of its rows were drawn.
    weight = np.array([1.0 / len(mine[x]) for x in labels])
    gram = (features * weight[:, None]).T @ features + RIDGE * np.eye(features.shape[1])
    return Model(languages, landmarks, root @ np.linalg.solve(gram, (features * weight[:, None]).T @ targets))


def fit(docs: DataFrame) -> Model | None:
    """A model from rows with a language whose id's crc32 leaves a remainder other than 2 by 4; None without such rows.

    At most about PER_LANGUAGE rows of each language are drawn, by hash, from all rows; only their packed presence vectors
    (4 KB each) come to the driver.
    """
    rows = docs.select("doc_id", "text", "lang").where((remainder(F.col("doc_id"), 4) != 2) & F.col("text").isNotNull())
    chosen = sampled(rows, "lang", PER_LANGUAGE, F.struct("doc_id", "text"))

    def run(of):
        for batch, raws in batches(of):
            langs = batch.column("lang").to_pylist()
            good = [i for i, raw in enumerate(raws) if has_letter(raw)]
            for i in range(0, len(good), ROWS):
                bits = np.packbits(presence([raws[j] for j in good[i : i + ROWS]]).astype(bool), axis=1)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([langs[j] for j in good[i : i + ROWS]], pa.string()), "bits": pa.array([b.tobytes() for b in bits], pa.binary())})

    got = sorted((r["lang"], bytes(r["bits"])) for r in chosen.mapInArrow(run, "lang string, bits binary").collect())
    if not got:
        return None
    bits = np.array([np.frombuffer(b, np.uint8) for _, b in got])
    return train(np.unpackbits(bits, axis=1).astype(np.float32), [lang for lang, _ in got])


SCORED = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    `und` with score 0 for null texts, texts without a letter, and all texts if nothing could be learned. Only text decides; repeated
    rows get the same answer each. Other columns are not read. An empty table gives no rows.
    """

    def run(of):
        landmarks = model.landmarks() if model else None
        for batch, raws in batches(of):
            known = [i for i, raw in enumerate(raws) if model and has_letter(raw)]
            langs, scores = ["und"] * len(raws), [0.0] * len(raws)
            for i in range(0, len(known), ROWS):
                part = known[i : i + ROWS]
                got = model.scores(presence([raws[j] for j in part]), landmarks)
                for j, row in zip(part, got):
                    best = int(row.argmax())
                    langs[j], scores[j] = model.languages[best], float(np.clip((row[best] + 1) / 2, 0, 1))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "held_out": batch.column("held_out"), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}
            )

    return docs.select("doc_id", "text", (remainder(F.col("doc_id"), 4) == 2).alias("held_out")).mapInArrow(run, SCORED)

