"""Manifest, prefix trie and language model against plain Python, on the smallest tables and on odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm import lm, merkle, queries, trie
from tests.compare import compare, duck
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def leaves(df):
    return sorted((tuple(r) for r in merkle.digest(df).collect()), key=str)


@pytest.mark.parametrize("name", list(queries.CHECKS))
def test_sql(spark, name):
    assert compare(spark, duck(SF_DIR), SF_DIR, queries.QUERIES[name], queries.CHECKS[name]) is None


def test_manifest_of_odd_rows(spark):
    """Null and repeated ids, equal rows, ids far apart, one source alone, more levels than one."""
    rows = [(None, "A", None, None, None), (None, "A", None, None, None), (None, None, None, None, 1), (5, "Up", "en", "", 2), (5, "Up", "en", "", 2)]
    rows += [(5, "up", "en", "", 2), (-(1 << 63), "x", None, "s", 0), ((1 << 63) - 1, "É Z", None, "s", 0), (0, "", "", "s", None), (7, "alone", "en", "é", 1)]
    rows += [(i * 3, "Text " * (i % 4), "en", "many", i) for i in range(300)] + [(9, f"copy {i % 7}", "en", "many", None) for i in range(40)]
    rows += [(11, "the same", "en", "ties", 1)] * 35 + [(12, "LONG " * 50_000, "en", "ties", 1)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute.merkle(df.collect())
    assert leaves(df.repartition(3).select("*", *(F.lit(1).alias(c) for c in ("src", "word", "idx", "leaf", "path", "tree", "run", "n")))) == want
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)


def test_manifest_of_few_rows(spark):
    for rows in ([], [(5, "Ab", None, None, 2)], [(i, "x", None, f"s{i:03}", 1) for i in range(40)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert leaves(df) == brute.merkle(df.collect())


def test_proofs_hold_for_other_rows(spark):
    """The general form: any leaves, with columns of the caller's."""
    df = spark.createDataFrame([(i, f"s{i % 3}", f"{i:064x}", i * 10) for i in range(50)], "doc_id long, source string, leaf string, mine int")
    got = merkle.proofs(df).withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert len(got) == 50 and all(r.again == r.root and r.mine == r.doc_id * 10 for r in got)
    assert sorted((r.source, r.idx) for r in got) == sorted((f"s{i % 3}", i // 3) for i in range(50))


def test_every_row_is_folded(spark, monkeypatch):
    """A wrong sibling shows in rows that nobody tampered with, and in texts that lower-casing leaves as they are."""
    right = merkle.proofs

    def wrong(leaves):
        return right(leaves).withColumn("path", F.transform("path", lambda p: F.struct(F.concat(F.lit("0"), p["before"]).alias("before"), p["after"].alias("after"))))

    df = spark.createDataFrame([(i, "low", "en", f"s{i % 2}", 1) for i in range(40)], SCHEMA)
    assert all(r.verified for r in merkle.digest(df).collect())
    monkeypatch.setattr(merkle, "proofs", wrong)
    found = merkle.digest(df).collect()
    assert len(found) == 40 and not any(r.verified or r.folded_root == r.root for r in found)


def test_plan_does_not_grow_with_levels(spark):
    """The driver plans one level at a time: more levels, or levels of sources, make no larger plan."""

    def joins(n, sources):
        rows = spark.range(n).select(F.col("id").alias("doc_id"), F.format_string("s%03d", F.col("id") % sources).alias("source"), *(F.lit(None).cast(t).alias(c) for c, t in (("text", "string"), ("lang", "string"), ("n_chars", "long"))))
        return merkle.digest(rows)._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(5000, 1) == joins(20, 1) == joins(600, 20) <= 3


@pytest.mark.parametrize("most", [3, 70_000])
def test_totals(spark, most):
    rnd = random.Random(most)
    cells = {(rnd.choice("ab"), rnd.randrange(most), rnd.randrange(5)): rnd.randrange(9) for _ in range(200)}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "k string, x long, y long, n long")
    for r in merkle.totals_before(df, ["k"], ["x", "y"]).collect():
        assert r.before == sum(v for k, v in cells.items() if k[0] == r.k and k[1:] < (r.x, r.y))


def nodes(df):
    return sorted((tuple(r) for r in trie.digest(df).collect()), key=str)


def test_trie_of_odd_rows(spark):
    rnd = random.Random(12)
    rows = [(None, 1, "user", "no conversation"), (7, None, "user", "first"), (7, 2, None, None), (7, 2, None, None), (-3, 0, "", "é"), (-5, 1, "user", "hi")]
    for c in range(60):
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "", None])) for t in range(rnd.choice([1, 2, 3, 12]))]
    rows += [(c, t, "user", f"{t} " * 20) for c in (100, 101, 105, 203) for t in range(75 + c % 2)]
    rows += [(300, 0, "user", "x" * 100_000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", *(F.lit(1).alias(c) for c in ("id", "key", "block", "t1", "head", "skip", "depth", "bytes")))
    assert nodes(df.repartition(5)) == brute.trie(rows)
    assert nodes(df.limit(0)) == []


def test_turns_of_one_place_keep_one_order(spark):
    """Different turns with one number: whatever order they are in, it is the same in each conversation."""
    rows = [(c, 1, "user", x) for c in (10, 15) for x in "abc"]
    got = [nodes(spark.createDataFrame(part, "conv_id long, turn long, role string, text string").coalesce(1)) for part in (rows, rows[::-1])]
    assert got[0] == got[1]


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op13_lm"](spark, SF_DIR).collect()}
    rows = docs.collect()
    for d, (held_out, n, known, total, base) in zip(rows, brute.unigram(rows)):
        r = got[d.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    assert len(got) == len(rows)


def test_model_on_odd_rows(spark):
    rows = [(None, "Not an id", None, None, None), (1, None, None, None, 1), (2, "", None, None, 2), (3, "same same", None, None, 3), (3, "same same", None, None, 3)]
    rows += [(4, "word " * 30_000 + "x" * 100_000, None, None, 4)] + [(i, f"é w{i} \t\n W{i % 3}", None, None, i) for i in range(10, 40)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(1).alias(c) for c in ("word", "c", "ids", "tail", "row", "held_out", "model")))
    want = [(d[0], *u) for d, u in zip(rows, brute.unigram(df.collect()))]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in lm.score(df).collect()]
    for g, w in zip(sorted(got, key=lambda r: str(r[:3])), sorted(want, key=lambda r: str(r[:3]))):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
    assert len(got) == len(want) and lm.score(df.limit(0)).collect() == []
    held = df.where("doc_id is not null and crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    assert all(r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) and r.score < 0 for r in lm.score(held).collect())


def test_words_beyond_the_head_count_alike(spark, monkeypatch):
    """Whether a word is held by tasks or looked up by a join makes no difference to what it counts."""
    rows = [(i, " ".join(f"w{(i * k) % 50}" for k in range(20)), None, None, 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {d[0]: u for d, u in zip(rows, brute.unigram(df.collect()))}
    for head in (0, 10, 1 << 18):
        monkeypatch.setattr(lm, "HEAD", head)
        for r in lm.score(df).collect():
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4] and r.base_score == pytest.approx(want[r.doc_id][4])


def test_chances_add_up(spark):
    """Over all words seen and one unseen word of each class, after any two words."""
    rows = [(i, "the cat sat on the mat . " * 3 + f"rare{i}", None, None, 1) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    words = lm.counted(docs)
    vocab = lm.vocabulary(words, 40)
    model = lm.fit(lm.encoded(docs, vocab), vocab)
    logs = model.log_z()
    for a, b in ((lm.BEGIN, lm.BEGIN), (0, 1), (lm.WORDS + 3, 2)):
        chance = np.exp((model.left[a] + model.right[b]) @ model.targets.T + model.bias - logs[a, b])
        assert chance.sum() == pytest.approx(1)
        inside = sum(chance[lm.WORDS + c] * (vocab.class_sizes[c] + vocab.class_words[c] + 1) / 10 ** vocab.class_logs()[c] for c in range(lm.CLASSES))
        assert chance[: lm.WORDS].sum() + inside + chance[lm.END] == pytest.approx(1)


def test_model_scores_are_its_chances(spark):
    rows = [(i, "the cat sat on the mat and the dog on the log", None, None, 1) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    vocab = lm.vocabulary(lm.counted(docs), 30)
    encoded = lm.encoded(docs, vocab)
    model = lm.fit(encoded, vocab)
    got = lm.scored(encoded, model).first()
    ids = np.frombuffer(encoded.first().ids, "<u2").astype(int)
    want, (a, b) = 0.0, (lm.BEGIN, lm.BEGIN)
    for w in ids:
        raw = (model.left[a] + model.right[b]) @ model.targets.T + model.bias
        want += (raw[w] - np.log(np.exp(raw).sum())) / math.log(10)
        a, b = b, w
    assert got.model == pytest.approx(want, rel=1e-9)


def test_model_learns_what_words_follow(spark):
    """Two languages of the same words but for their order: only what came before tells them apart."""
    rnd = random.Random(1)
    follows = {f"w{i}": [f"w{(i * 7 + k) % 100}" for k in range(1, 4)] for i in range(100)}

    def text():
        out = [f"w{rnd.randrange(100)}"]
        while len(out) < 150:
            out.append(rnd.choice(follows[out[-1]]))
        return " ".join(out)

    got = lm.score(spark.createDataFrame([(i, text(), None, None, 1) for i in range(1500)], SCHEMA)).where("held_out").collect()
    tokens = sum(r.n_tokens for r in got)
    base, model = (sum(r[c] for r in got) / tokens for c in ("base_score", "score"))
    assert base == pytest.approx(-2, abs=0.1) and model > -1.3
