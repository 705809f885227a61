"""URL filters: host and path rules, and association rules mined from labelled URLs."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import ascii_lower, saved

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A rule holds for this many labelled URLs at least, whatever the share asked for.
LEAST = 10
#: The item that stands for a bad label in a transaction; no token starts like it.
BAD = "= bad"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*+)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null without one. Of equally long ones the first in text order wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """What a URL is made of, numbers as `0`: scheme, labels of the host, path segments and their endings, keys of the query. Sorted, each once."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "0")
    query = F.regexp_extract(url, r"\?([^#]*+)", 1)
    marked = lambda sign, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(sign), x))
    return F.array_sort(F.array_distinct(F.filter(F.concat(
        marked("s ", F.array(plain(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*+)://", 1)))),
        marked("h ", F.split(plain(host), r"\.")),
        marked("p ", F.split(plain(path), "/")),
        marked("e ", F.array(F.regexp_extract(plain(path), r"\.([a-z]{1,8})$", 1))),
        marked("q ", F.transform(F.split(plain(query), "&"), lambda x: F.substring_index(x, "=", 1))),
    ), lambda x: x.isNotNull())))


def mine(labelled: DataFrame, support: float, confidence: float) -> DataFrame:
    """Rules (tokens, n, confidence): URLs with all the tokens are bad with that confidence, in `support` of the labelled URLs and LEAST of them at least.

    `labelled` holds tokens and bad (boolean). FP-growth counts the combinations; a rule that a shorter rule implies is pruned, as are tokens that all URLs share.
    """
    empty = labelled.sparkSession.createDataFrame([], "tokens array<string>, n int, confidence double")
    items = F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens")).alias("items")
    rows = saved(labelled.where("size(tokens) > 0").select("tokens", "bad", items), "url-items")
    totals = rows.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")).first()
    if not totals["bad"]:
        return empty
    counts = rows.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    common = [r["t"] for r in counts.where(F.col("n") > 0.95 * totals["n"]).collect()]  # 20 tokens a URL at most can be as common
    told = rows.select(F.array_except("items", F.array(*(F.lit(t) for t in common)).cast("array<string>")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=max(support, min(1.0, LEAST / totals["n"])), minConfidence=confidence).fit(told.where("size(items) > 0"))
    rules = model.associationRules.where(F.array_contains("consequent", BAD)).select(
        F.array_sort("antecedent").alias("tokens"), F.size("antecedent").alias("n"), "confidence"
    )
    rules = saved(rules, "url-rules")
    # A rule is pruned if it has all tokens of a shorter one: found through the shorter rule's first token.
    longer = rules.select("tokens", "n", F.explode("tokens").alias("t"))
    shorter = rules.select(F.col("tokens").alias("part"), F.col("n").alias("m"), F.get("tokens", F.lit(0)).alias("t"))
    implied = longer.join(shorter, "t").where((F.col("m") < F.col("n")) & (F.size(F.array_except("part", "tokens")) == 0)).select("tokens").distinct()
    return saved(rules.join(implied, "tokens", "left_anti"), "url-rules")


def matched(token_sets: DataFrame, rules: DataFrame, labelled_tokens: DataFrame) -> DataFrame:
    """(tokens, rule_confidence) for the token sets that have all tokens of a rule.

    The index lists each rule under its rarest token among the URLs, so common tokens look nothing up; what it finds is compared in full.
    """
    counts = labelled_tokens.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("uses"))
    posts = rules.select("tokens", "confidence", F.explode("tokens").alias("t")).join(counts, "t", "left")
    index = saved(
        posts.groupBy(F.col("tokens").alias("rule"), "confidence").agg(F.min_by("t", F.struct(F.coalesce("uses", F.lit(0)), "t")).alias("t")),
        "url-index",
    )
    seen = token_sets.select("tokens", F.explode("tokens").alias("t")).join(index, "t")
    return seen.where(F.size(F.array_except("rule", "tokens")) == 0).groupBy("tokens").agg(F.max("confidence").alias("rule_confidence"))


def judge(
    pages: DataFrame, labels: DataFrame, rules=RULES, support: float = 0.002, confidence: float = 0.8
) -> DataFrame:
    """page_id, host, path, rule, verdict and rule_confidence per page.

    A host and path rule decides first. Without one a page is blocked if its URL has all tokens of a mined rule, else allowed. Labels are those of
    the documents with the page's id: bad is low quality or toxic. Rules are mined from all labelled pages, and matched once for every different set of
    tokens, which is what equal templates share. Null URLs have an empty host and path, no rule and no tokens, and are allowed. Repeated rows get the same
    verdict each; without labels nothing is mined. An empty table gives no rows. Columns but page_id and url are not read.
    """
    url, host, path = F.col("url"), host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = saved(
        pages.select("page_id", "url", host.alias("host"), path.alias("path"))
        .select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), tokens(url, F.col("host"), F.col("path")).alias("tokens")),
        "url-pages",
    )
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad")
    )
    labelled = saved(rows.select("page_id", "tokens").join(told, "page_id"), "url-labelled")
    sets = saved(rows.where("ruled is null and size(tokens) > 0").groupBy("tokens").agg(F.count("*").alias("n")), "url-sets")
    found = saved(matched(sets, mine(labelled, support, confidence), labelled), "url-found")
    return rows.join(found, "tokens", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("rule_confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.col("rule_confidence")).alias("rule_confidence"),
    )
