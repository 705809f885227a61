"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.llm.common import WORD, let, saved

#: Weights of the sources in their order, repeating; the share of all words that the mix has; the most passes over a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words that a block should hold, and bits of the hash that tell blocks apart: 4096 blocks of a source at most, which then are larger.
BLOCK_WORDS, BLOCK_BITS = 4096, 12
#: Levels of the splitting tree: 2 to the power of it shards.
LEVELS = 4
SEED = 10


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """`target` for sources (source, source_size): shares by weight, stopped at MOST times the size, the excess shared anew.

    That ends with target = least(MOST * size, level * weight) for one level, which is found among the sources sorted by the level at which they stop.
    There is one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    rows = sources.withColumn("place", place).withColumn("weight", weight)
    rows = rows.withColumn("cap", F.col("source_size") * float(MOST)).withColumn("stops", F.col("cap") / F.col("weight"))
    up = Window.orderBy("stops", "place").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy("stops", "place").rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * SHARE
    rows = rows.withColumn("level", (total - F.coalesce(F.sum("cap").over(up), F.lit(0.0))) / F.sum("weight").over(down))
    # The first source in that order that doesn't stop at its level sets the level of all that follow.
    first = F.min(F.when(F.col("level") <= F.col("stops"), F.struct("stops", "place", "level"))).over(Window.partitionBy())
    return rows.withColumn("target", F.least(F.col("cap"), F.coalesce(first["level"], F.lit(0.0)) * F.col("weight"))).select(
        "source", "source_size", "place", "target"
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, unit: Column) -> Column:
    """How many of `drawn` out of `total` are marked, by inverting the distribution at `unit` in [0, 1).

    Chances are followed by the ratio of neighbours across 12 deviations on both sides of the mode, which is all there is to double precision.
    """
    double = lambda c: c.cast("double")

    def inverted(p: Column) -> Column:
        n, k, m = double(p["n"]), double(p["k"]), double(p["m"])
        low, high = F.greatest(F.lit(0.0), m + k - n), F.least(m, k)
        mode = F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")
        reach = F.ceil(12 * F.sqrt(F.greatest(m * k / F.greatest(n, F.lit(1.0)) * (1 - k / F.greatest(n, F.lit(1.0))), F.lit(0.0)))) + 16
        bounds = F.struct(F.greatest(low, mode - reach).cast("long").alias("a"), F.least(high, mode + reach).cast("long").alias("b"))

        def summed(r: Column) -> Column:
            ratio = lambda x: (k - x) * (m - x) / ((x + 1) * F.greatest(n - k - m + x + 1, F.lit(1.0)))
            steps = F.sequence(r["a"], F.greatest(r["a"], r["b"]))
            whole = F.aggregate(
                steps, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s")),
                lambda s, x: F.struct((s["p"] * ratio(double(x))).alias("p"), (s["s"] + s["p"]).alias("s")), lambda s: s["s"],
            )
            return let(whole, lambda w: F.aggregate(
                steps, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s"), r["b"].alias("x")),
                lambda s, x: F.struct(
                    (s["p"] * ratio(double(x))).alias("p"), (s["s"] + s["p"]).alias("s"),
                    F.when((s["s"] <= p["u"] * w) & (s["s"] + s["p"] > p["u"] * w), x).otherwise(s["x"]).alias("x"),
                ),
                lambda s: s["x"],
            ))

        return let(bounds, summed)

    return let(F.struct(total.alias("n"), marked.alias("k"), drawn.alias("m"), unit.alias("u")), inverted)


def split(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """(shard, place, quota): the blocks (place, quota) of sources dealt out to 2**levels shards of equal size (but for one block).

    A node of the tree holds the quota of every source. Its left half gets half of its blocks; how many of them are of each source is drawn from the multivariate
    hypergeometric distribution, source by source, given what is left; the right half gets the others. So quotas stay exact at each level. The
    state is one number per source and node.
    """
    node = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("place", F.col("quota").cast("long").alias("k")))).alias("all"))
    node = node.select(F.lit(0).alias("shard"), "all")
    for level in range(levels):
        node = _halved(node, level, seed)
    return node.select("shard", F.inline("all")).withColumnRenamed("k", "quota")


def _halved(node: DataFrame, level: int, seed: int) -> DataFrame:
    """Two nodes (shard, all: places with their k) for each."""
    total = F.aggregate("all", F.lit(0).cast("long"), lambda a, s: a + s["k"])
    start = F.struct(
        total.alias("n"), F.floor((total + F.col("shard") % 2) / 2).cast("long").alias("m"),
        F.array().cast("array<struct<place:int,k:bigint,left:bigint>>").alias("out"),
    )

    def step(a: Column, s: Column) -> Column:
        unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), F.col("shard"), s["place"]), 11).cast("double") / float(1 << 53)
        return let(
            hypergeometric(a["n"], s["k"], a["m"], unit).cast("long"),
            lambda x: F.struct(
                (a["n"] - s["k"]).alias("n"), (a["m"] - x).alias("m"),
                F.concat(a["out"], F.array(F.struct(s["place"].alias("place"), s["k"].alias("k"), x.alias("left")))).alias("out"),
            ),
        )

    dealt = node.select("shard", F.aggregate("all", start, step, lambda a: a["out"]).alias("dealt"))
    left = F.transform("dealt", lambda s: F.struct(s["place"].alias("place"), s["left"].alias("k")))
    right = F.transform("dealt", lambda s: F.struct(s["place"].alias("place"), (s["k"] - s["left"]).alias("k")))
    halves = F.array(*(F.struct((F.col("shard") * 2 + i).alias("shard"), side.alias("all")) for i, side in enumerate((left, right))))
    return dealt.select(F.explode(halves).alias("x")).select("x.*")


def _parts(hashed: Column, bits: Column) -> tuple[Column, Column, Column]:
    """The block of a hash, and the keys by which blocks and the next 4096 parts of a block are put in a random order."""
    whole = F.shiftrightunsigned(hashed, 64 - BLOCK_BITS)
    block = F.floor(whole / F.pow(F.lit(2), F.lit(BLOCK_BITS) - bits)).cast("long")
    return block, F.xxhash64(F.lit(SEED), block), F.xxhash64(F.lit(SEED + 1), F.shiftrightunsigned(hashed, 64 - 2 * BLOCK_BITS))


def _taken_last(hashed: Column, bits: Column) -> Column:
    """Whether the last pass of a source with cut_block, cut_part and cut_hash reaches the row before it ends."""
    _, key, part = _parts(hashed, bits)
    return (key < F.col("cut_block")) | (
        (key == F.col("cut_block")) & ((part < F.col("cut_part")) | ((part == F.col("cut_part")) & (hashed < F.col("cut_hash"))))
    )


def plan(sized: DataFrame) -> DataFrame:
    """One row per source of rows (source, size, hash): its target, whole passes, where the last pass ends, and the shard of each block in each pass.

    All counts are over all rows. The last pass takes blocks in a random order, of the block where the target falls parts in a random order, and of that part rows in the order
    of their hash, and one more row that fills the gap best; so what is read in order is 4096 counts, 4096 counts and a few rows, however large a source is.
    """
    fine = saved(
        sized.groupBy("source", F.shiftrightunsigned("hash", 64 - BLOCK_BITS).alias("cell")).agg(F.sum("size").alias("words")), "mix-cells"
    )
    sources = targets(fine.groupBy("source").agg(F.sum("words").alias("source_size")))
    bits = F.least(F.lit(BLOCK_BITS), F.ceil(F.log2(F.greatest(F.col("source_size") / BLOCK_WORDS, F.lit(1.0))))).cast("int")
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(F.lit(0)).cast("int")
    sources = saved(
        sources.withColumn("bits", bits).withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "mix-sources",
    )
    same = F.col("source").eqNullSafe(F.col("_source"))
    per = sources.withColumnRenamed("source", "_source")
    width = F.pow(F.lit(2), F.lit(BLOCK_BITS) - F.col("bits"))
    blocks = fine.join(per, same).groupBy("place", F.floor(F.col("cell") / width).cast("long").alias("block")).agg(F.sum("words").alias("words"))
    blocks = saved(blocks.withColumn("key", F.xxhash64(F.lit(SEED), "block")), "mix-blocks")

    def crossing(rows: DataFrame, rest: str, *order: str) -> DataFrame:
        """Of each source the row in which the sum reaches what is to be taken, and what is left for it."""
        before = F.coalesce(F.sum("words").over(Window.partitionBy("place").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        left = F.col(rest) - F.col("before")
        return rows.withColumn("before", before).where((left > 0) & (left <= F.col("words"))).withColumn("left", left)

    cut = saved(
        crossing(blocks.join(sources.select("place", "rest"), "place"), "rest", "key", "block").select("place", F.col("key").alias("cut_block"), F.col("left").alias("rest2")),
        "mix-cut",
    )
    cuts = sources.join(cut, "place", "left")
    located = sized.join(cuts.withColumnRenamed("source", "_source"), same)
    _, key, part = _parts(F.col("hash"), F.col("bits"))
    edge = saved(
        located.where("rest2 is not null").where(key == F.col("cut_block")).select("place", "rest2", part.alias("part"), "hash", "size"), "mix-edge"
    )
    parts = edge.groupBy("place", "rest2", "part").agg(F.sum("size").alias("words"))
    cut2 = saved(crossing(parts, "rest2", "part").select("place", F.col("part").alias("cut_part"), F.col("left").alias("rest3")), "mix-cut2")
    last = edge.join(cut2, "place").where(F.col("part") == F.col("cut_part")).groupBy("place", "rest3", "hash").agg(F.sum("size").alias("words"))
    # The prefix ends before the row in which the target falls; `gap` words are left.
    cut3 = saved(
        crossing(last, "rest3", "hash").select("place", F.col("hash").alias("cut_hash"), F.col("left").alias("gap")), "mix-cut3"
    )
    # Of the rows that the last pass leaves, the one whose size is nearest to the gap is taken too, if that comes nearer.
    located = sized.join(
        sources.withColumnRenamed("source", "_source").join(cut.select("place", "cut_block"), "place")
        .join(cut2.select("place", "cut_part"), "place").join(cut3, "place"), same
    )
    off = F.abs(F.col("words") - F.col("gap"))
    spare = (
        located.where(~_taken_last(F.col("hash"), F.col("bits"))).groupBy("place", "gap", "hash").agg(F.sum("size").alias("words"))
        .where(off < F.col("gap")).groupBy("place").agg(F.min_by("hash", F.struct(off, "hash")).alias("spare_hash"))
    )
    cut3 = cut3.join(saved(spare, "mix-spare"), "place", "left").select("place", "cut_hash", "spare_hash")
    ranked = blocks.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy("key", "block")) - 1)
    ranked = ranked.join(cut.select("place", "cut_block"), "place", "left")
    counted = ranked.groupBy("place").agg(
        F.count("*").alias("blocks"), F.count(F.when(F.col("key") <= F.col("cut_block"), 1)).alias("last_blocks"),
        F.map_from_entries(F.collect_list(F.struct("block", "rank"))).alias("ranks"),
    )
    counted = saved(counted.join(sources.select("place", "passes"), "place"), "mix-counted")
    quotas = counted.select("place", (F.col("blocks") * F.col("passes") + F.col("last_blocks")).alias("quota"))
    shards = saved(split(quotas), "mix-shards")
    upto = shards.groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "quota"))), lambda s: s["quota"]).alias("quotas"))
    ends = F.transform("quotas", lambda _, i: F.aggregate(F.slice("quotas", 1, i + 1), F.lit(0).cast("long"), lambda a, x: a + x))
    return saved(
        sources.join(cut, "place", "left").join(cut2.select("place", "cut_part"), "place", "left").join(cut3, "place", "left")
        .join(counted.select("place", "blocks", "ranks"), "place").join(upto.withColumn("ends", ends).select("place", "ends"), "place"),
        "mix-plan",
    )


def drawn(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """The rows of `docs`, each as `row`, with size, hash, source_size, target, times (how often the mix takes the row) and shards (one for each time).

    Every row of a source is drawn in each whole pass; the last, partial pass draws disjoint blocks in a random order until the target. Draws of blocks are
    dealt to shards by the quotas of the splitting tree. Rows with equal id, source and size share a hash and are drawn alike; else a source's words miss its target by less than half of the row in which it falls.
    Only hashes of these columns decide, so reruns agree.

    A null source is a source, the last. Null texts have size 0; so have empty ones: their rows are drawn with their block and add nothing. A source
    without words has target 0 and none of its rows is taken. An empty table gives no rows.
    """
    sized = docs.select(F.struct("*").alias("row"), (size_of(F.col("text")) if size is None else size).alias("size"))
    sized = sized.select("row", "size", F.col("row.source").alias("source"), F.xxhash64(F.lit(SEED), "row.doc_id", "row.source", "size").alias("hash"))
    narrow = saved(sized.select("source", "size", "hash"), "mix-sizes")
    per = plan(narrow).withColumnRenamed("source", "_source")
    block = _parts(F.col("hash"), F.col("bits"))[0]
    last = F.coalesce(_taken_last(F.col("hash"), F.col("bits")), F.lit(False)) | F.col("hash").eqNullSafe(F.col("spare_hash"))
    times = F.col("passes") + last.cast("int")
    shard = lambda e, rank: F.size(F.filter("ends", lambda x: x <= e * F.col("blocks") + rank)).cast("int")
    rows = sized.join(per, F.col("source").eqNullSafe(F.col("_source"))).withColumn("times", times)
    turns = F.filter(F.sequence(F.lit(0), F.lit(MOST)), lambda e: e < F.col("times"))
    shards = let(F.element_at(F.col("ranks"), block), lambda rank: F.transform(turns, lambda e: shard(e, rank)))
    return rows.withColumn("shards", shards).select("row", "size", "hash", "source_size", "target", "times", "shards")


def mix(docs: DataFrame) -> DataFrame:
    """For every draw the document as `row`, its shard, and the order by which the shard is shuffled."""
    rows = drawn(docs).select("row", "hash", F.posexplode("shards").alias("turn", "shard"))
    return rows.select("row", F.col("shard"), F.xxhash64(F.lit(SEED + 2), "hash", "turn").alias("order"))


def shuffled(docs: DataFrame) -> DataFrame:
    """The mix in the order of its shards, each shuffled: sorted within partitions, a shard's rows in ranges of their order."""
    return mix(docs).repartitionByRange("shard", "order").sortWithinPartitions("shard", "order")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards."""
    return drawn(docs.select("doc_id", "source", "text")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"),
        F.concat_ws(",", F.transform("shards", lambda s: s.cast("string"))).alias("shards"),
    )
