"""Merkle manifest of a dataset: leaves placed by ranks in bitmaps of ids, levels reduced through slot arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.llm.common import ascii_lower, remainder, saved

#: Nodes that make one of the next level.
FAN = 16
#: Ids of one bitmap word, and of one place of a directory level.
WORD_BITS, STEP_BITS = 6, 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts in a row."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of values in a row: `-` for a null one, else its UTF-8 byte count, `:`, and the value."""
    texts = [f.cast("string") for f in fields]
    return digest_of(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def totals_before(rows: DataFrame, keys: list[str], path: list[str], n: str = "n") -> DataFrame:
    """The rows with `before`: the sum of `n` over rows of equal keys and a smaller path. Paths are unique for a key.

    A directory in levels: each window holds one step of the path, so as many rows as the last part of a path has values under one beginning,
    however many rows there are.
    """
    above = [*keys, *path[:-1]]
    within = Window.partitionBy(*above).orderBy(path[-1]).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum(n).over(within), F.lit(0)))
    if len(path) == 1:
        return placed
    parents = totals_before(rows.groupBy(*above).agg(F.sum(n).alias(n)), keys, path[:-1], n)
    parents = parents.select(*above, F.col("before").alias("_above"))
    return placed.join(parents, above).withColumn("before", F.col("before") + F.col("_above")).drop("_above")


def _word_ranks(leaves: DataFrame) -> tuple[DataFrame, Column, Column]:
    """(src, word, bits, n, before): the bitmap of ids of each source in words of 64, and how many rows of the source come before a word.

    Empty words are left out, so a bitmap is never larger than its ids. Parts of it are merged by bitwise or, on the map side first. Null ids have the word before all others,
    without bits. Also the word of an id and its place there.
    """
    ends = leaves.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    first = ((ends.lo or 0) >> WORD_BITS) - 1
    span = ((ends.hi or 0) >> WORD_BITS) - first
    word = F.coalesce(F.shiftright("doc_id", WORD_BITS), F.lit(first).cast("long"))
    low = F.col("doc_id").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    bits = F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), low)), F.lit(0).cast("long"))
    words = saved(leaves.groupBy("src", word.alias("word")).agg(bits.alias("bits"), F.count("*").alias("n")), "merkle-words")
    steps = max(1, -(-span.bit_length() // STEP_BITS))
    digit = lambda i: F.shiftright(F.col("word") - F.lit(first), STEP_BITS * i).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
    path = {f"_d{i}": digit(i) for i in reversed(range(steps))}
    ranked = totals_before(words.withColumns(path), ["src"], list(path)).drop(*path)
    return saved(ranked, "merkle-directory"), word, low


def coordinates(leaves: DataFrame) -> DataFrame:
    """The rows of (src, doc_id, leaf, others) with `idx`: their place among the rows of the source by doc_id.

    A row's place is what its source's directory counts before its word, and the bits below its own in the word; nothing is sorted. Rows that
    share an id come in the order of their leaves, null ids first; equal rows get one place each.
    """
    words, word, low = _word_ranks(leaves)
    tied = F.col("n") > F.bit_count("bits")
    at = leaves.withColumn("word", word)
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), low))))
    plain = at.join(words.where(~tied), ["src", "word"]).select(*leaves.columns, (F.col("before") + below).alias("idx"))
    if words.where(tied).isEmpty():
        return plain
    same = ["src", "word", "start", *[c for c in leaves.columns if c != "src"]]
    shared = at.join(words.where(tied).select("src", "word", F.col("before").alias("start")), ["src", "word"])
    byte = lambda i: F.conv(F.substring("leaf", 2 * i + 1, 2), 16, 10).cast("int")
    path = {"_low": F.coalesce(low, F.lit(0)), "_b0": byte(0), "_b1": byte(1), "_b2": byte(2)}
    groups = saved(shared.groupBy(*same).agg(F.count("*").alias("n")).withColumns(path), "merkle-ties")
    placed = totals_before(groups, ["src", "word"], [*path, "leaf"])
    # Copies in blocks, so that very many of one row are not written out by one task.
    block = 4096
    placed = placed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block))))
    placed = placed.repartition("src", "word", "leaf", "_k").withColumn(
        "_i", F.explode(F.sequence(F.col("_k") * block, F.least(F.col("n"), (F.col("_k") + 1) * block) - 1))
    )
    return plain.unionByName(placed.select(*leaves.columns, (F.col("start") + F.col("before") + F.col("_i")).alias("idx")))


def _gathered(nodes: DataFrame, name: str) -> DataFrame:
    """(tree, run, rows): nodes (tree, idx, row: struct with `digest`) in arrays of FAN slots; a node's place in its array is its key."""
    slots = F.map_from_entries(F.collect_list(F.struct((F.col("idx") % FAN).cast("int"), "row")))
    runs = nodes.groupBy("tree", F.floor(F.col("idx") / FAN).cast("long").alias("run")).agg(slots.alias("slots"))
    return saved(
        runs.select("tree", "run", F.transform(F.sequence(F.lit(0), F.size("slots") - 1), lambda i: F.col("slots")[i]).alias("rows")), name
    )


def _lone() -> Column:
    """Whether a run holds the only node of its tree: that is the top."""
    return (F.col("run") == 0) & (F.size("rows") == 1)


def _digests() -> Column:
    return F.transform("rows", lambda r: r["digest"])


def _levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The runs of all levels of the trees, from the nodes given to where each tree is one node."""
    levels = [_gathered(nodes, f"{name}-0")]
    while not (more := levels[-1].where(~_lone())).isEmpty():
        up = more.select("tree", F.col("run").alias("idx"), F.struct(F.sha2(F.array_join(_digests(), ""), 256).alias("digest")).alias("row"))
        levels.append(_gathered(up, f"{name}-{len(levels)}"))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the node that remains of each tree."""
    found = [runs.where(_lone()).select("tree", F.col("rows")[0]["digest"].alias("digest")) for runs in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _spread(runs: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of the runs, each with `path`: the digests before and after it in its run, then those of the runs above."""
    all_ = _digests()
    fold = lambda i: F.struct(
        F.array_join(F.slice(all_, F.lit(1), i), "").alias("before"), F.array_join(F.slice(all_, i + 2, F.lit(FAN)), "").alias("after")
    )
    nodes = runs.withColumn("_nodes", F.transform("rows", lambda r, i: F.struct(r.alias("row"), fold(i).alias("fold")))).withColumn("_lone", _lone())
    nodes = nodes.drop("rows").join(above, ["tree", "run"])
    nodes = nodes.select("tree", "run", "_lone", *[c for c in above.columns if c not in ("tree", "run")], F.posexplode("_nodes").alias("_i", "_node"))
    path = F.when(F.col("_lone"), F.col("path")).otherwise(F.concat(F.array("_node.fold"), F.col("path")))
    return nodes.withColumn("path", path).withColumn("idx", F.col("run") * FAN + F.col("_i")).withColumn("row", F.col("_node.row")).drop("run", "_lone", "_i", "_node")


def _nodes_with_paths(levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The nodes of the lowest level with their paths to the top; `tops` has (tree, path, others), and the others are handed down.

    What a level hands down is written: the plan of one level is all that the driver holds, however many there are.
    """
    tops, above = saved(tops, f"{name}-tops"), None
    for level in reversed(range(len(levels))):
        own = levels[level].where(_lone()).select("tree", "run").join(tops, "tree")
        above = own if above is None else above.unionByName(own)
        nodes = _spread(levels[level], above)
        if level:
            above = saved(nodes.drop("row").withColumnRenamed("idx", "run"), f"{name}-paths-{level}")
    return nodes


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """The rows with `idx`, their place by a unique key: cut into ranges, numbered in each, counts of ranges added up."""
    ranges = saved(rows.repartitionByRange(key).withColumn("_range", F.spark_partition_id()).withColumn("n", F.lit(1).cast("long")), "merkle-sources")
    return totals_before(ranges, [], ["_range", key]).withColumnRenamed("before", "idx").drop("_range", "n")


_PATH = "array<struct<before:string,after:string>>"


def proofs(leaves: DataFrame) -> DataFrame:
    """The rows of (source, doc_id, leaf, others) with idx, path, subroot and root.

    Each source has a tree over its leaves by doc_id (see `coordinates`), and one more tree stands over the sources' tops by name, null first. While several nodes remain, each
    FAN in a row become the digest of their digests. `path` holds, level by level up to the root, the digests before and after the node in
    its run, each as one text; a level where a tree has one node has none.

    A null source is a source. An empty table gives no rows.
    """
    src = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    leaves = leaves.withColumn("src", src)
    rest = [c for c in leaves.columns if c not in ("src", "source")]
    row = F.struct(F.col("leaf").alias("digest"), *rest)
    levels = _levels(coordinates(leaves.drop("source")).select(F.col("src").alias("tree"), "idx", row.alias("row")), "merkle-leaves")
    subroots = _numbered(_tops(levels), "tree")
    sources = _levels(subroots.select(F.lit("").alias("tree"), "idx", F.struct("digest", F.col("tree").alias("src")).alias("row")), "merkle-tops")
    root = _tops(sources).select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    tops = _nodes_with_paths(sources, root, "merkle-tops").select(F.col("row.src").alias("tree"), "path", F.col("row.digest").alias("subroot"), "root")
    out = _nodes_with_paths(levels, tops, "merkle-leaves")
    name = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    return out.select(name.alias("source"), "idx", *(F.col("row")[c].alias(c) for c in rest), "path", "subroot", "root")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, digest, lambda d, p: digest_of(p["before"], d, p["after"]))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows whose id's crc32 divides by 5 are tampered with: A-Z of their text are lower-cased before the check; a null id is none of these. A text without A-Z stays what it was and is
    verified. Every row is folded up its path, tampered with or not. Null values of any column count as `-`, empty ones as `0:`. Repeated rows are leaves each, in places next to each
    other. Texts are read whole, once. Other columns are not read. An empty table gives no rows.
    """
    mark = F.coalesce(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) == 0), F.lit(False))
    fields = [F.col(c) for c in FIELDS]
    changed = F.when(mark, leaf([*fields[:-1], ascii_lower(F.col("text"))]))
    leaves = saved(docs.select("source", "doc_id", leaf(fields).alias("leaf"), changed.alias("changed")), "merkle-leaves")
    found = proofs(leaves)
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    found = found.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
