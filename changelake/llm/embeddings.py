"""Embedding near-duplicates by tiles of PCA-ordered vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import saved
from changelake.llm.graph import components

#: Vectors in a block; a tile compares two blocks. Dimensions added at a time.
BLOCK, STEP = 1024, 16
#: Room for rounding in the bounds; survivors are compared exactly.
SLACK = 1e-9


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors the orthogonal matrix whose columns are its principal directions, largest first, over all unit vectors.

    Tasks add up outer products; Spark adds the tasks'. The driver gets one square matrix for each length.
    """

    def run(of):
        sums: dict[int, np.ndarray] = {}
        for batch in of:
            vectors = batch.column("vector").to_pylist()
            for d in {len(v) for v in vectors}:
                x = np.array([v for v in vectors if len(v) == d], float)
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            n = d * d
            yield pa.RecordBatch.from_pydict({"d": np.full(n, d, np.int32), "place": np.arange(n, dtype=np.int64), "x": s.ravel()})

    got = vectors.select("vector").mapInArrow(run, "d int, place long, x double").groupBy("d", "place").agg(F.sum("x").alias("x")).collect()
    flat: dict[int, np.ndarray] = {}
    for r in got:
        flat.setdefault(r["d"], np.zeros(r["d"] ** 2))[r["place"]] = r["x"]
    out = {}
    for d, values in flat.items():
        _, directions = np.linalg.eigh(values.reshape(d, d))
        out[d] = np.ascontiguousarray(directions[:, ::-1])
    return out


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of unit rows of `a` and `b`, leading dimensions first, that may reach the threshold; i < j if they are the same rows.

    The products of the first dimensions are summed; what the rest can add is at most the product of the norms of the rest (Cauchy and
    Schwarz). Pairs that can't reach the threshold with it go, until few enough are left to finish one by one.
    """
    d = a.shape[1]
    rest = lambda x, k: np.sqrt(np.maximum((x[:, k:] ** 2).sum(1), 0))
    k = min(STEP, d)
    products = a[:, :k] @ b[:, :k].T
    alive = products + np.outer(rest(a, k), rest(b, k)) >= threshold - SLACK
    if same:
        alive &= np.tri(len(a), len(b), -1, dtype=bool).T
    i, j = np.nonzero(alive)
    sums = products[i, j]
    while k < d and len(i):
        up = min(k + STEP, d)
        sums = sums + np.einsum("ij,ij->i", a[i, k:up], b[j, k:up])
        k = up
        keep = sums + rest(a, k)[i] * rest(b, k)[j] >= threshold - SLACK
        i, j, sums = i[keep], j[keep], sums[keep]
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that links lead to, for each of n places."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
    while (root != root[root]).any():
        root = root[root]
    return root


def _tile(pdf: pd.DataFrame, threshold: float, rotation: dict[int, np.ndarray]) -> pd.DataFrame:
    first, second = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    pdf = pdf.sort_values("cls", kind="stable")
    sides = [pdf[pdf["block"] == first], pdf[pdf["block"] == second]]
    empty = pd.DataFrame({"cls": np.zeros(0, np.int64), "other": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
    if not len(sides[0]) or not len(sides[1]):
        return empty
    raw = [np.array(s["vector"].tolist(), float) for s in sides]
    raw = [x / np.abs(x).max(1, keepdims=True) for x in raw]  # squares of very large or small numbers stay in range
    units = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in raw]
    turned = [x @ rotation[x.shape[1]] for x in units]
    same = first == second
    i, j = close_pairs(turned[0], turned[1], threshold, same)
    norms = [np.linalg.norm(x, axis=1) for x in raw]
    exact = np.array([], bool)
    if len(i):
        exact = np.concatenate([
            np.einsum("ij,ij->i", raw[0][p], raw[1][q]) / (norms[0][p] * norms[1][q]) >= threshold
            for p, q in zip(np.array_split(i, len(i) // 65536 + 1), np.array_split(j, len(j) // 65536 + 1))
        ])
    i, j = i[exact], j[exact]
    if not len(i):
        return empty
    ids = [s["cls"].to_numpy(np.int64) for s in sides]
    weight = [s["copies"].to_numpy(np.int64) for s in sides]
    n0, n1 = (len(ids[0]), len(ids[1]))
    gained = np.bincount(i, weight[1][j], n0).astype(np.int64), np.bincount(j, weight[0][i], n1).astype(np.int64)
    if same:
        root = _forest(n0, i, j)
        every, total = ids[0], gained[0] + gained[1]
    else:
        root = _forest(n0 + n1, i, j + n0)
        every, total = np.concatenate(ids), np.concatenate(gained)
    hit = total > 0
    return pd.DataFrame({"cls": every[hit], "other": every[root][hit], "n": total[hit]})


def group(rows: DataFrame, threshold: float = 0.93, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Rows with equal label and vector form a class that is compared once. The classes of a label and length are cut into blocks of about `block`, by the
    order of a hash, and every two blocks of a label make a tile that one task call compares, so memory is that of two blocks however large a label is. Within a
    tile the dimensions are those of the principal directions, leading ones first. A tile returns, for each class with links, the number of vectors linked
    there and one tie to the smallest class that its links reach: never the pairs, which a large group of near copies makes many of. The ties of all tiles give
    the components.

    A null label, or a vector that is null, empty, zero, or holds null or non-finite components, links with nothing: n_links 0 and a component of
    its own. A null vec_id is never a component_id unless the component has no other. Repeated rows are vectors of their own with
    equal ids. An empty table gives no rows. Other columns are not read.
    """
    vector = F.transform("embedding", lambda x: x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(
        F.col("label").isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0.0), F.lit(False)
    )
    rows = saved(rows.select("vec_id", "label", vector.alias("vector"), usable.alias("usable")), "vectors")
    good = rows.where("usable").select("vec_id", "label", "vector")
    classes = good.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    classes = saved(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    counts = classes.groupBy("label", F.size("vector").alias("d")).agg(F.count("*").alias("n_classes"))
    blocked = (
        classes.withColumn("d", F.size("vector")).join(saved(counts, "vector-counts"), ["label", "d"])
        .withColumn("blocks", F.ceil(F.col("n_classes") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks").cast("long")).cast("int"))
    )
    rotation = rotations(classes)
    with_all = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    tiles = (
        blocked.select("label", "d", "cls", "copies", "vector", "block", with_all)
        .withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))
    )
    ties = saved(
        tiles.groupBy("label", "d", "i", "j").applyInPandas(lambda pdf: _tile(pdf, threshold, rotation), "cls long, other long, n long"), "vector-ties"
    )
    sums = ties.groupBy("cls").agg(F.sum("n").alias("n"))
    roots = components(ties.select(F.col("cls").alias("a"), F.col("other").alias("b"))).toDF("cls", "root")
    rooted = saved(
        classes.select("cls", "label", "vector", "copies", "first").join(roots, "cls", "left").join(sums, "cls", "left")
        .withColumn("root", F.coalesce("root", "cls")).withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1),
        "vector-rooted",
    )
    ids = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "vector-ids")
    named = saved(rooted.join(ids, "root").select("label", "vector", "n_links", "component_id"), "vector-named")
    linked = good.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
