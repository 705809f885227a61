"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import saved
from changelake.llm.graph import components
from changelake.llm.tokens import batches

BITS, SEED = 64, 42
#: Buckets with more fingerprints than this are linked through the values between them, not pair by pair.
PAIRWISE = 48


def fingerprint(raw: bytes | None, width: int) -> int:
    """A bit is 1 if more than half of the shingles' XXH64 have it; 0 for a text without words."""
    import xxhash

    words = (raw or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    n = max(1, len(words) - width + 1)
    ends = starts[width:] if len(words) >= width else starts[-1:]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[at : min(n, at + (1 << 16))], ends[at:])]
        raw_bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += raw_bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `fp`, a signed 64-bit number, per document."""
    kept = docs.select(*keep, "text")
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) + ", fp long"

    def run(of):
        for batch, raws in batches(of):
            fps = pa.array([fingerprint(raw, width) for raw in raws], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), fps], names=[*keep, "fp"])

    return kept.mapInArrow(run, schema)


@dataclass(frozen=True)
class Plan:
    """Masks of the bit groups and how many bits of each may differ for a probe to find it (-1: not probed)."""

    masks: tuple[int, ...]
    thresholds: tuple[int, ...]


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def grouped(correlation: np.ndarray, groups: int) -> list[list[int]]:
    """Bits in groups of about equal size: each takes the bit that correlates most with those it has."""
    left, out = set(range(BITS)), []
    sizes = [BITS // groups + (g < BITS % groups) for g in range(groups)]
    strength = np.abs(correlation)
    for size in sizes:
        first = max(sorted(left), key=lambda b: strength[b, sorted(left)].sum())
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(sorted(left), key=lambda b: strength[b, group].sum())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], distance: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds t_i >= -1 with sum(t) = distance - groups + 1 and the least total cost, by dynamic programming.

    costs[i][t + 1] is the estimated cost of threshold t in group i. If all bits that differ between two fingerprints are at most
    `distance`, some group i has at most t_i of them: else their number were sum(t_i + 1) = distance + 1 at least.
    """
    goal = distance + 1  # sum of t_i + 1
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for group in costs:
        following: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for step, extra in enumerate(group[: goal - used + 1]):
                now = (cost + extra, (*chosen, step - 1))
                if used + step not in following or now < following[used + step]:
                    following[used + step] = now
        best = following
    return best[goal]


def _flips(width: int, threshold: int) -> int:
    """Values within `threshold` bits of a value of `width` bits."""
    total, ways = 0, 1
    for k in range(threshold + 1):
        total += ways
        ways = ways * (width - k) // (k + 1)
    return total


def plan(fps: DataFrame, distance: int) -> Plan:
    """Groups of correlated bits and their thresholds, from counts over all fingerprints.

    Two and more groups are tried. The candidates of a group at threshold t are estimated as the pairs with equal values in it times the number of values within t bits,
    the cost as these and the probes that are made.
    """

    def run(of):
        sums, n = np.zeros((BITS, BITS)), 0
        for batch in of:
            bits = np.unpackbits(np.asarray(batch.column("fp")).astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            sums += (bits.T @ bits).astype(float)
            n += len(bits)
        places = np.arange(BITS * BITS, dtype=np.int64)
        yield pa.RecordBatch.from_pydict({"place": np.append(places, -1), "ones": np.append(sums.ravel(), float(n))})

    ones = fps.mapInArrow(run, "place long, ones double").groupBy("place").agg(F.sum("ones").alias("ones")).collect()
    got = {r["place"]: r["ones"] for r in ones}
    n = max(got.get(-1, 0.0), 1.0)
    both = np.array([got.get(i, 0.0) for i in range(BITS * BITS)]).reshape(BITS, BITS) / n
    share = np.diag(both)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = (both - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    options = [[_signed(sum(1 << b for b in g)) for g in grouped(correlation, m)] for m in range(2, distance + 2)]
    masks = sorted({x for option in options for x in option})
    parts = fps.select(
        F.explode(F.array(*(F.struct(F.lit(x).alias("mask"), F.col("fp").bitwiseAND(F.lit(x)).alias("value")) for x in masks))).alias("part")
    )
    equal = {
        r["mask"]: r["pairs"]
        for r in parts.groupBy("part.mask", "part.value").agg(F.count("*").cast("double").alias("n"))
        .groupBy("mask").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()
    }
    found = []
    for option in options:
        costs = []
        for x in option:
            width = bin(x & (1 << 64) - 1).count("1")
            expected = (equal.get(x) or 0.0) + n * n / 2 / 2.0**width
            costs.append([0.0] + [expected * _flips(width, t) + n * (1 + _flips(width, t)) for t in range(distance + 1)])
        cost, thresholds = allocate(costs, distance)
        found.append((cost, option, thresholds))
    _, option, thresholds = min(found, key=lambda x: x[0])
    return Plan(tuple(option), thresholds)


def _near(value: Column, mask: int, threshold: int) -> Column:
    """All values within `threshold` bits of a value inside a mask."""
    bits = [_signed(1 << b) for b in range(BITS) if mask >> b & 1]
    masks = {0}
    for _ in range(threshold):
        masks |= {_signed((m ^ b) & (1 << 64) - 1) for m in masks for b in bits}
    return F.transform(F.array(*(F.lit(m) for m in sorted(masks))), lambda m: value.bitwiseXOR(m))


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) between different fingerprints that join exactly those that chains of links of at most `distance` bits join.

    Every fingerprint is filed under its value in each group that the plan probes, and probes the values within the group's threshold. Pairs that meet
    are verified on all bits. A bucket with more than PAIRWISE fingerprints isn't paired: each of its fingerprints (and those that probe it) is
    joined with the values half the distance away, and those that share such a value, which are within the distance of each other, are tied in a star. So many
    near copies cost as many rows as there are copies. (For odd distances the halves are rounded up, and ties are verified.)
    """
    fps = saved(fps.select("fp").where("fp is not null").distinct(), "fps")
    chosen = plan(fps, distance)
    probed = [(i, m, t) for i, (m, t) in enumerate(zip(chosen.masks, chosen.thresholds)) if t >= 0]
    part = lambda i, m: F.col("fp").bitwiseAND(F.lit(m))
    filed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("part"), part(i, m).alias("value")) for i, m, _ in probed))).alias("s")).select("fp", "s.*")
    probe = lambda i, values: F.transform(values, lambda v: F.struct(F.lit(i).alias("part"), v.alias("value")))
    near = F.concat(*(probe(i, _near(part(i, m), m & (1 << 64) - 1, t)) for i, m, t in probed))
    probes = fps.select(F.col("fp").alias("other"), F.explode(near).alias("s")).select("other", "s.*")
    sizes = saved(filed.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > PAIRWISE), "buckets")
    full = sizes.select("part", "value")
    pairs = (
        filed.join(full, ["part", "value"], "left_anti")
        .join(probes, ["part", "value"])
        .where((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance))
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )
    crowd = probes.join(full, ["part", "value"], "left_semi").select(F.col("other").alias("fp")).distinct()
    between = crowd.select("fp", F.explode(_near(F.col("fp"), (1 << 64) - 1, distance // 2)).alias("middle"))
    # Different fingerprints within one bit of a value are 65 at most, so the lists are short whatever the crowd.
    stars = (
        between.groupBy("middle").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
        .select(F.get("fps", F.lit(0)).alias("a"), F.explode(F.slice("fps", 2, 1 << 30)).alias("b"))
    )
    return saved(pairs.union(stars).distinct(), "links")


def grouped_docs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = 3, distance: int = 2) -> DataFrame:
    """`keep`, fp and component_id (the smallest doc_id that links reach) per document.

    Fingerprints are of the lower-cased (A-Z) words' shingles, repeats included; a text of fewer words is one shingle. Null texts and texts without
    words have fingerprint 0 and are linked like any other. Equal fingerprints are linked, so exact copies and repeated rows fall
    together before any search. A null doc_id is never a component_id; it is null where a component has no other. An empty table
    gives no rows; other columns are not read.
    """
    if distance != 2:
        raise ValueError("the stars in crowded buckets are exact for a distance of 2")
    rows = saved(fingerprints(docs, width, tuple(dict.fromkeys((*keep, "doc_id")))), "fingerprints")
    firsts = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(links(firsts, distance)).toDF("fp", "root")
    rooted = saved(firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "ids")
    named = saved(rooted.join(ids, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    rows = grouped_docs(docs)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group: that with the smallest doc_id (null only where there is no other) and, of several texts with that id, hash."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    rows = grouped_docs(rows, ("doc_id", "_h"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_h")).alias("w")
    group = F.coalesce("component_id", "fp")
    winners = saved(rows.groupBy(F.col("component_id").isNull(), group).agg(first).select("w.doc_id", "w._h"), "winners")
    whole = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("_h"))
    stay = whole.join(
        winners.toDF("_id", "_wh"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_wh")), "left_semi"
    )
    return stay.dropDuplicates(["doc_id", "_h"]).select("row.*")
