"""Connected components by contraction."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) of bigint; the root is one node of its component.

    Each round hooks every node to the smallest of itself and its neighbours and puts that node in its place in all edges;
    loops and repeats go. An edge from a node to its hook ties the hook to the hook's own, so nothing falls apart. The order
    is that of the numbers in the first round, which folds stars around their smallest node at once, then that of the
    numbers xor a mask that changes, so that long chains fold by a fraction each round as well. A round is
    written to the shared folder; the joins stand directly on their shuffles, so Spark can split a node with very many
    edges. Edges with nulls are left out; no edges, no rows.
    """
    edges = saved(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    roots, masks, mask = None, random.Random(5), 0
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        smallest = F.least(F.col("a").bitwiseXOR(F.lit(mask)), F.min(F.col("b").bitwiseXOR(F.lit(mask))))
        hooks = saved(ends.groupBy("a").agg(smallest.bitwiseXOR(F.lit(mask)).alias("hook")).toDF("node", "hook"), "hooks")
        if roots is None:
            roots = hooks.withColumnRenamed("hook", "root")
        else:
            up = hooks.toDF("root", "hook")
            roots = saved(roots.join(up, "root", "left").select("node", F.coalesce("hook", "root").alias("root")), "roots")
        half = saved(edges.join(hooks.toDF("a", "x"), "a").select("x", "b"), "edges")
        edges = saved(
            half.join(hooks.toDF("b", "y"), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .where("a < b")
            .distinct(),
            "edges",
        )
        mask = masks.getrandbits(62)
    return edges.toDF("node", "root") if roots is None else roots
