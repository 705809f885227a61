"""Personal data: base patterns, and more identifiers found by bootstrapped contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import let, saved
from changelake.llm.spans import HIT, first_words, hits, last_words, named

# The base patterns of each kind, in the order of kinds. Possessive, and started only where a run starts or
# the last match ended, they find the same spans as the plain ones in one pass.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: A word with a digit or an at sign, from where it starts.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Candidates are no longer than this, and have this many letters and digits at least.
LONGEST, SHORTEST = 64, 5
#: Positions are cut into cells of this size to find candidates that overlap a base span.
CELL = 64


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def doubled(d: Column) -> Column:
        return F.when(d > 4, d * 2 - 9).otherwise(d * 2)

    numbers = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    total = F.aggregate(F.transform(numbers, lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d)), F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def _fits(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
        return F.forall(F.split(value, r"\."), small)
    n = F.length(_digits(value))
    return n.between(13, 19) & _luhn(_digits(value)) if kind == "card" else n.between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    found = F.filter(hits(text, pattern), lambda s: _fits(kind, s["value"]))
    sign = {"email": "@", "phone": "+"}.get(kind)
    return F.when(text.contains(sign), found).otherwise(F.array().cast(HIT)) if sign else found


def _contexts(span: Column) -> Column:
    """Patterns around a span: the word before, the two before, the words on both sides."""

    def made(before: Column, after: Column) -> Column:
        one, two, next_ = F.get(before, F.lit(0)), F.get(before, F.lit(1)), F.get(after, F.lit(0))
        return F.filter(
            F.array(
                F.concat(F.lit("b "), one),
                F.concat(F.lit("bb "), two, F.lit(" "), one),
                F.concat(F.lit("ba "), one, F.lit(" _ "), next_),
            ),
            lambda c: c.isNotNull(),
        )

    return let(last_words(span["before"]), lambda b: let(first_words(span["after"]), lambda a: made(b, a)))


def _shape(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(value), "[0-9]+", "9"), r"\p{L}+", "a")


def detect(
    docs: DataFrame, support: int = 5, confident: float = 0.8, accepted: float = 0.9, rounds: int = 3
) -> DataFrame:
    """One row per document: doc_id, the base spans of each kind, and `found`, spans that contexts led to.

    Base spans are the seeds. A pattern is a context around seeds: the word before, two words before, or the words on both sides; it
    counts for a kind if at least `support` different values of that kind stand in it. Words with digits or an at sign
    that overlap no base span are candidates. Patterns and values (seeds and candidates) form a graph; in each round a pattern's
    confidence for a kind is the mean score of the values it holds, and a candidate's score is 1 - product(1 - confidence) over its
    patterns of at least `confident`. Seeds score 1 for their kind and 0 for the others. Candidates that end with
    `accepted` for a kind, and whose shape is a seed's of that kind or stands in two such patterns, are found.

    Null texts count as empty ones and have no spans. Repeated rows get the same spans each; doc_id may be null or repeat. Other columns of
    the input are not read, whatever their names. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.struct(F.xxhash64("doc_id", text).alias("a"), F.xxhash64(F.lit(7), text, "doc_id").alias("b"))
    candidate = F.filter(
        hits(text, CANDIDATE),
        lambda s: (F.length(s["value"]) <= LONGEST) & (F.length(F.regexp_replace(s["value"], r"[^\p{L}0-9]", "")) >= SHORTEST),
    )
    held = saved(
        docs.select(
            "doc_id", key.alias("key"), *(base_spans(text, k).alias(k) for k in KINDS), candidate.alias("candidate")
        ),
        "pii-spans",
    )
    marks = held.select(
        "key", F.inline(F.concat(*(_marks(k) for k in (*KINDS, "candidate"))))
    ).distinct()
    marks = saved(marks, "pii-marks")
    seeds = marks.where("kind <> 'candidate'")
    free = saved(_apart(marks.where("kind = 'candidate'"), seeds), "pii-free")
    found = _bootstrapped(seeds, free, support, confident, accepted, rounds)
    per_doc = found.groupBy("key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("found"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return held.drop("candidate").join(per_doc, "key", "left").withColumn("found", F.coalesce("found", none)).drop("key")


def _marks(kind: str) -> Column:
    return F.transform(
        kind,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            _contexts(s).alias("contexts"),
        ),
    )


def _bounds(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def _of_kind(kind: str) -> Column:
    """Base and found spans of a kind."""
    return F.array_sort(F.concat(_bounds(F.col(kind)), _bounds(F.filter("found", lambda s: s["kind"] == kind))))


def _apart(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """Candidates that overlap no base span of their document; ends of punctuation are cut off first."""
    lead = F.length("value") - F.length(F.regexp_replace("value", r"^[^\p{L}0-9]+", ""))
    trail = F.length("value") - F.length(F.regexp_replace("value", r"[^\p{L}0-9]+$", ""))
    cut = candidates.select(
        "key", (F.col("start") + lead).alias("start"), (F.col("end") - trail).alias("end"),
        F.regexp_replace("value", r"^[^\p{L}0-9]+|[^\p{L}0-9]+$", "").alias("value"), "contexts",
    )
    cells = lambda s, e: F.explode(F.sequence(F.floor(s / CELL), F.floor((e - 1) / CELL)))
    taken = seeds.select("key", cells(F.col("start"), F.col("end")).alias("cell"), F.col("start").alias("s"), F.col("end").alias("e"))
    hit = (
        cut.withColumn("cell", cells(F.col("start"), F.col("end")))
        .join(taken, ["key", "cell"])
        .where((F.col("start") < F.col("e")) & (F.col("s") < F.col("end")))
        .select("key", "start", "end")
        .distinct()
    )
    return cut.join(hit, ["key", "start", "end"], "left_anti")


def _bootstrapped(seeds: DataFrame, free: DataFrame, support: int, confident: float, accepted: float, rounds: int) -> DataFrame:
    spark = seeds.sparkSession
    seed_edges = seeds.select(F.explode("contexts").alias("context"), "kind", F.lower("value").alias("value")).distinct()
    patterns = saved(seed_edges.groupBy("context", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= support), "pii-patterns")
    none = spark.createDataFrame([], free.select("key", "start", "end").schema).withColumn("kind", F.lit("email"))
    if patterns.isEmpty():
        return none
    held = patterns.select("context").distinct()
    sizes = seed_edges.groupBy("context").agg(F.countDistinct("value").alias("n_seeds"))
    free_edges = saved(
        free.select(F.explode("contexts").alias("context"), F.lower("value").alias("value")).distinct().join(held, "context"),
        "pii-edges",
    )
    counts = free_edges.groupBy("context").agg(F.count("*").alias("n_free"))
    patterns = saved(
        patterns.join(sizes, "context").join(counts, "context", "left")
        .withColumn("n", F.col("n_seeds") + F.coalesce("n_free", F.lit(0))).drop("n_seeds", "n_free"),
        "pii-patterns",
    )
    scores = None
    for _ in range(rounds):
        gained = F.lit(0.0)
        scored = patterns
        if scores is not None:
            sums = free_edges.join(scores, "value").groupBy("context", "kind").agg(F.sum("score").alias("gained"))
            scored = patterns.join(sums, ["context", "kind"], "left")
            gained = F.coalesce("gained", F.lit(0.0))
        sure = scored.withColumn("confidence", (F.col("seeds") + gained) / F.col("n")).where(F.col("confidence") >= confident)
        sure = saved(sure.select("context", "kind", "confidence"), "pii-sure")
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        scores = saved(
            free_edges.join(sure, "context").groupBy("value", "kind")
            .agg((1 - F.exp(doubt)).alias("score"), F.count("*").alias("n_patterns")),
            "pii-scores",
        )
    shapes = seeds.select("kind", _shape(F.col("value")).alias("shape")).distinct()
    good = (
        scores.where(F.col("score") >= accepted).withColumn("shape", _shape(F.col("value")))
        .join(shapes.withColumn("known", F.lit(True)), ["kind", "shape"], "left")
        .where((F.col("n_patterns") >= 2) | F.col("known"))
        .groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    )
    # A value is reported where it stands in one of the sure contexts of its kind.
    here = free.select("key", "start", "end", F.lower("value").alias("value"), F.explode("contexts").alias("context"))
    return (
        here.join(saved(good, "pii-good"), "value").join(sure.select("context", "kind"), ["context", "kind"], "left_semi")
        .select("key", "start", "end", "kind").distinct()
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found."""
    rows = detect(docs)
    base = F.concat(*(named(F.col(k), k) for k in KINDS))
    every = F.concat(*(named(_of_kind(k), k) for k in KINDS))
    return rows.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", every).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )
