"""Secrets: base patterns, and credentials in several parts linked by where they stand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import let, saved
from changelake.llm.spans import HIT, hits

# The base patterns, in the order of kinds.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
)
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex")

#: Parts that mean little alone. Identifiers name an account, secrets open it, endpoints say where.
PARTS = {
    "identifier": r"(?i:\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.@-]{3,}+)|\bAKIA[A-Z0-9]{4,}+",
    "weak": r"(?i:\b(?:pass|pwd|pass_?phrase|auth|credential|private_?key|sig(?:nature)?)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]{6,}+)"
    r"|(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]{0,64}[0-9])(?=[a-z0-9+/_-]{0,64}[A-Z])(?=[A-Z0-9+/_-]{0,64}[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}",
    "endpoint": r"\b(?:https?|jdbc:[a-z]++|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3a?|ftp)://[^\s\"'<>]++"
    r"|(?i:\b(?:host(?:name)?|endpoint|server|base_?url)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9._:/-]{4,}+)",
}
#: Parts link within so many code points of each other.
SCOPE = 200


def base_spans(text: Column, kind: str) -> Column:
    if kind == "assign":
        value = lambda s: F.regexp_extract(s["value"], "^" + ASSIGN, 1)
        return F.filter(hits(text, ASSIGN), lambda s: F.length(value(s)) >= 6)
    if kind == "access":
        found = F.filter(hits(text, ACCESS), lambda s: F.length(s["value"]) >= 20)
        return F.when(text.contains("AKIA"), found).otherwise(F.array().cast(HIT))
    return hits(text, HEX)


def detect(docs: DataFrame, whole: bool = False) -> DataFrame:
    """One row per document: doc_id or, if `whole`, the document as `row`, the base spans of each kind, and `linked`, spans reported for their company.

    Parts are identifiers, weak secrets and endpoints; base spans take part as what they are (access: identifier, assign and hex: secret).
    A weak secret is reported where an identifier or endpoint stands within SCOPE code points of it in the same document, an identifier or endpoint that isn't a base span where
    a secret does. The join is on the document and cells of SCOPE code points, and those next to them; a cell
    holds few parts however long the text. A part that overlaps a base span is that base span.

    Null texts count as empty. Repeated rows get the same spans each; ids may be null or repeat. An empty table gives no rows. Other columns are
    not read.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.struct(F.xxhash64("doc_id", text).alias("a"), F.xxhash64(F.lit(7), text, "doc_id").alias("b"))
    held = saved(
        docs.select(
            F.struct("*").alias("row") if whole else F.col("doc_id"), key.alias("_key"), *(base_spans(text, k).alias(f"_{k}") for k in KINDS),
            *(hits(text, p).alias(f"_{k}") for k, p in PARTS.items()),
        ),
        "secret-spans",
    )
    slim = lambda k: F.transform(f"_{k}", lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    marks = held.select("_key", F.inline(F.concat(*(slim(k) for k in (*KINDS, *PARTS))))).distinct()
    linked = _linked(saved(marks, "secret-marks"))
    per_doc = linked.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("_linked"))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return (
        held.drop(*(f"_{k}" for k in PARTS)).join(per_doc, "_key", "left")
        .withColumn("_linked", F.coalesce("_linked", none)).drop("_key")
    )


def _linked(marks: DataFrame) -> DataFrame:
    """Weak parts with a complementary part in scope: _key, kind, start, end."""
    near = F.explode(F.sequence(F.floor(F.col("start") / SCOPE) - 1, F.floor((F.col("end") - 1) / SCOPE) + 1))
    here = F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE)))
    base = marks.where(F.col("kind").isin(*KINDS))
    parts = marks.where(~F.col("kind").isin(*KINDS))
    taken = base.select("_key", here.alias("cell"), F.col("start").alias("s"), F.col("end").alias("e"))
    covered = (
        parts.withColumn("cell", here).join(taken, ["_key", "cell"])
        .where((F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))).select("_key", "kind", "start", "end").distinct()
    )
    free = saved(parts.join(covered, ["_key", "kind", "start", "end"], "left_anti"), "secret-parts")
    secret = F.col("kind").isin("assign", "hex", "weak")
    every = base.union(free.select(base.columns)).withColumn("secret", secret)
    company = every.select("_key", here.alias("cell"), F.col("secret").alias("other"), F.col("start").alias("s"), F.col("end").alias("e"))
    gap = F.greatest(F.col("s") - F.col("end"), F.col("start") - F.col("e"))
    return (
        free.withColumn("secret", secret).withColumn("cell", near).join(company, ["_key", "cell"])
        .where((F.col("secret") != F.col("other")) & (gap >= 0) & (gap <= SCOPE))
        .select("_key", "kind", "start", "end").distinct()
    )


def _sorted_names(rows: Column) -> Column:
    return F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))


def all_spans(linked: bool = True) -> Column:
    """Spans of a detected row by start, then kind."""
    order = {k: i for i, k in enumerate((*KINDS, *PARTS))}

    def of(k: str) -> Column:
        return F.transform(
            f"_{k}", lambda s: F.struct(s["start"].alias("start"), F.lit(order[k]).alias("rank"), s["end"].alias("end"), F.lit(k).alias("kind"))
        )

    arrays = [of(k) for k in KINDS]
    if linked:
        ranks = F.create_map(*(F.lit(x) for k in PARTS for x in (k, order[k])))
        arrays.append(
            F.transform("_linked", lambda s: F.struct(s["start"].alias("start"), F.element_at(ranks, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
        )
    return F.array_sort(F.concat(*arrays))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows = detect(docs)
    return rows.select(
        "doc_id",
        *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.concat_ws(",", _sorted_names(all_spans(False))).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", _sorted_names(all_spans())).alias("spans"),
        F.size("_linked").cast("long").alias("n_linked"),
    )


def masked(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span (overlaps as one) replaced by a mask and n_chars counted anew where there is such a column.

    Texts without spans, null ones included, stay as they are.
    """
    rows = detect(docs, whole=True)

    def cut(spans: Column) -> Column:
        step = lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"])
            .otherwise(F.concat(a["out"], F.substring(F.col("row.text"), a["at"] + 1, s["start"] - a["at"]), F.lit(mask)))
            .alias("out"),
        )
        return F.aggregate(
            spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
            lambda a: F.concat(a["out"], F.substring(F.col("row.text"), a["at"] + 1, F.length("row.text"))),
        )

    clean = let(all_spans(), lambda s: F.when(F.size(s) > 0, cut(s)).otherwise(F.col("row.text")))
    out = rows.select(F.col("row"), clean.alias("clean"))
    fields = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        same = F.col("clean").eqNullSafe(F.col("row.text"))
        counted = F.length("clean").cast(docs.schema["n_chars"].dataType)
        fields["n_chars"] = F.when(same, F.col("row.n_chars")).otherwise(counted)
    return out.select(*(x.alias(c) for c, x in fields.items()))
