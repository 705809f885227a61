"""Prefix trie of conversations: ROLLUP over columns of turn ids gives all prefixes at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.llm.common import saved

#: Turn-id columns of a block; longer conversations go on in further blocks.
WIDTH = 8
#: Conversations are rebuilt from the one whose id has this remainder taken off, and up to HEADS - 1 of its turns.
FAMILY, HEADS = 5, 9
#: Conversation ids that one text of a node's ends holds, as bits of the id.
CHUNK_BITS = 12
ID_BYTES, ROOT = 16, bytes(16)
TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
BLOCKS = "conv_id long, block int, key binary, " + ", ".join(f"{t} binary" for t in TURNS) + ", ends_at binary"


def turn_id(role: Column, text: Column) -> Column:
    """20 bytes for a turn: 128 bits of a SHA-256 over role and text, and the UTF-8 bytes of the text; nulls count as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.left(whole, F.lit(2 * ID_BYTES)), F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def _head_size(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def _cut(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of WIDTH turns from rows in the order of conversations and turns, each with a key of all that comes before it.

    A conversation's first row has its head (`skip` turns of its own are left out then), the others its turns. Only the block at hand is kept.
    """
    conv, skip, block, key, turns = None, 0, 0, ROOT, []
    out: list[tuple] = []

    def put(end: bool) -> None:
        nonlocal block, key, turns
        nxt = key if not turns else hashlib.sha256(key + b"".join(turns)).digest()[:ID_BYTES]
        out.append((conv, block, key, *turns, *[None] * (WIDTH - len(turns)), nxt if end else None))
        block, key, turns = block + 1, nxt, []

    def batch() -> pa.RecordBatch:
        nonlocal out
        names = ["conv_id", "block", "key", *TURNS, "ends_at"]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * (WIDTH + 2)]
        columns, out = list(zip(*out)), []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for rows in of:
        for c, head, size, turn in zip(*(rows.column(n).to_pylist() for n in ("conv_id", "head", "skip", "id"))):
            if size is not None:
                if conv is not None:
                    put(True)
                conv, skip, block, key, turns = c, size, 0, ROOT, list(head or ())
            elif skip:
                skip -= 1
            else:
                if len(turns) == WIDTH:
                    put(False)
                turns.append(turn)
            if len(out) >= 10_000:
                yield batch()
    if conv is not None:
        put(True)
    if out:
        yield batch()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, block, key, t1 ... t8, ends_at): every conversation c in blocks of its turn ids.

    c is made of the first h turns of c - c % 5 and its own turns after its first h, h being the crc32 of c modulo 9; see `digest` for odd rows. Texts are hashed where they are
    read. A conversation's turns come sorted to one task, which keeps eight of them at a time. `key` stands for all turns before the block, `ends_at` for
    the node where the conversation ends, in its last block.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), "turn", turn_id(F.col("role"), F.col("text")).alias("id"))
    turns = saved(turns, "trie-turns")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    first = turns.where(F.col("conv_id") % FAMILY == 0).withColumn("place", F.row_number().over(order)).where(F.col("place") < HEADS)
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("head"))
    ids = turns.select("conv_id").distinct().withColumn("skip", _head_size(F.col("conv_id")))
    starts = ids.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base"), "left")
    starts = starts.select("conv_id", F.slice(F.transform("head", lambda t: t["id"]), 1, F.col("skip")).alias("head"), "skip", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("id"))
    own = turns.select("conv_id", F.lit(None).cast("array<binary>").alias("head"), F.lit(None).cast("int").alias("skip"), F.col("turn").cast("long"), "id")
    rows = starts.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", F.col("skip").asc_nulls_last(), F.col("turn").asc_nulls_first(), "id")
    return saved(rows.mapInArrow(_cut, BLOCKS), "trie-blocks")


def rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """One row per node: key, parent_key, depth, bytes of its last turn, and the SQL aggregates over its members.

    ROLLUP makes a group for each beginning of the eight columns; grouping_id tells which. Groups of a block are apart by what comes before it, so all blocks
    are rolled up together. The beginning of no turn is a node in the first block only (the root), as it is the last one of the block before in others.
    """
    columns = ", ".join(TURNS)
    rows = blocks.sparkSession.sql(
        f"SELECT block, key AS prior, {columns}, grouping_id() AS gid, {measures} FROM {{blocks}} GROUP BY block, key, ROLLUP({columns})", blocks=blocks
    )
    level = F.lit(WIDTH) - F.length(F.regexp_replace(F.bin("gid"), "0", ""))
    rows = rows.withColumn("level", level.cast("int"))
    last = F.element_at(F.array(*TURNS), F.greatest(F.col("level"), F.lit(1)))
    rows = rows.withColumn("last", F.when(F.col("level") > 0, last)).where(F.col("last").isNotNull() | ((F.col("level") == 0) & (F.col("block") == 0)))

    def chained(upto: Column) -> Column:
        parts = (F.when(F.lit(i) <= upto, F.col(t)).otherwise(F.lit(b"")) for i, t in enumerate(TURNS, 1))
        return F.when(upto > 0, F.unhex(F.left(F.sha2(F.concat("prior", *parts), 256), F.lit(2 * ID_BYTES)))).otherwise(F.col("prior"))

    size = F.conv(F.hex(F.substring("last", ID_BYTES + 1, 4)), 16, 10).cast("long")
    return rows.select(
        chained(F.col("level")).alias("key"), F.when(F.col("level") > 0, chained(F.col("level") - 1)).alias("parent_key"),
        (F.col("block").cast("long") * WIDTH + F.col("level")).alias("depth"), F.coalesce(size, F.lit(0)).cast("long").alias("bytes"),
        *[c for c in rows.columns if c not in ("block", "prior", "gid", "level", "last", *TURNS)],
    )


def _hashed(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's texts joined by commas; rows come sorted by key and chunk."""
    at, state = None, None
    keys, found = [], []
    for rows in of:
        for key, text in zip(rows.column("key").to_pylist(), rows.column("ids").to_pylist()):
            if key != at:
                if state is not None:
                    keys.append(at)
                    found.append(state.hexdigest())
                at, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], ["key", "ends_sha256"])
            keys, found = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])


def _ends(blocks: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes where conversations end. Ids are joined in chunks first, so few rows of a crowded node meet in one task, which only runs the hash over them."""
    ends = blocks.where(F.col("ends_at").isNotNull()).select(F.col("ends_at").alias("key"), "conv_id")
    chunks = ends.groupBy("key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("key", "chunk", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "ids").mapInArrow(_hashed, "key binary, ends_sha256 string")


def trie(blocks: DataFrame) -> DataFrame:
    """One row per node of the blocks (see `rebuilt`): key, parent_key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation that is the smallest member of a node is so below it too. What subtrees sum up is therefore given to conversations: each carries the sums of
    the nodes it is smallest in, a second ROLLUP adds them up over the members of a node, and what the node's own smallest member carries from above it is
    taken off. No level waits for another.
    """
    nodes = saved(rolled(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id"), "trie-nodes")
    kids = nodes.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    saves = (F.col("n_convs") - 1) * F.col("bytes")
    nodes = nodes.join(kids, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")).withColumn("own", saves)
    nodes = saved(nodes, "trie-kids")
    carried = nodes.groupBy("conv_id").agg(F.sum("own").alias("carried"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    sums = rolled(blocks.join(carried, "conv_id", "left"), "coalesce(sum(carried), 0) AS carried, coalesce(sum(leaf), 0) AS n_leaves").select("key", "carried", "n_leaves")
    chain = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("above", F.coalesce(F.sum("own").over(chain), F.lit(0)))
    nodes = saved(nodes.join(sums, "key").join(_ends(blocks), "key", "left"), "trie-sums")
    # A parent may have very many children: the join stands on its shuffles, so Spark can split it.
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(parents, "parent_key", "left").select(
        "key", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("carried") - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node of the rebuilt conversations.

    Turns come in the order of `turn`, null first; those of one turn in that of their ids, so equal rows are turns each. Null roles and texts count as empty. Rows without conv_id
    belong to no conversation and are left out. A conversation may be rebuilt to no turn; it is a member of the root alone. Texts count whole. Of other columns nothing is read. An empty table gives no rows, so no root either.
    """
    return trie(rebuilt(conversations)).drop("key", "parent_key")
