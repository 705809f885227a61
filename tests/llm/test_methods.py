"""The parts of the methods: components, bounds, thresholds, prices, draws, contexts and company."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm import embeddings, graph, mixing, packing, pii, quality, secrets, simhash, toxicity
from tests.llm import brute


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5000, 1050), (None, 3), (7, 7)]
    edges += [(rng.randrange(10_000, 10_400), rng.randrange(10_000, 10_400)) for _ in range(250)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    clean = [(a, b) for a, b in edges if a is not None and a != b]
    want = brute.components({x for e in clean for x in e}, clean)
    assert got.keys() == want.keys()
    roots = {}
    assert all(roots.setdefault(got[x], want[x]) == want[x] for x in want) and len(roots) == len(set(want.values()))
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_in_crowds(spark):
    """Crowded buckets give the components of all pairs, with few edges."""
    rng = random.Random(2)
    base = rng.getrandbits(64)
    values = {base ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(64), 2) if rng.random() < 0.4}
    values |= {base ^ sum(1 << b for b in rng.sample(range(64), 9)) for _ in range(300)}
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = sorted(simhash._signed(v) for v in values)
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    pairs = [(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    assert set(tuple(sorted(e)) for e in edges) <= {tuple(sorted(p)) for p in pairs}
    assert brute.components(signed, [tuple(e) for e in edges]) == brute.components(signed, pairs)
    assert len(edges) <= 65 * len(values)


def test_thresholds():
    cost, chosen = simhash.allocate([[0, 1, 50, 99], [0, 10, 11, 99]], 2)
    assert (cost, chosen) == (12, (0, 1))
    _, chosen = simhash.allocate([[0, 1, 9, 99], [0, 1, 9, 99], [0, 1, 9, 99]], 2)
    assert chosen == (0, 0, 0)


def test_bounds_of_tiles():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(60, 40)) * np.linspace(3, 0.1, 40)
    b = np.vstack([a[:30] + rng.normal(size=(30, 40)) * 0.2, rng.normal(size=(20, 40))])
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    for same, other in ((False, b), (True, a)):
        i, j = embeddings.close_pairs(a, other, 0.9, same)
        want = {(x, y) for x, y in zip(*np.nonzero(a @ other.T >= 0.9)) if not same or x < y}
        assert want <= set(zip(i.tolist(), j.tolist()))


def test_one_large_class_in_small_tiles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.1).tolist(), 1) for i in range(150)] + [(200 + i, rng.normal(size=8).tolist(), 1) for i in range(60)]
    got = embeddings.group(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=32).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute.embedding_groups(rows)


def test_prices():
    values = np.full(21, -np.inf)
    values[[3, 5, 8]] = [3, 6, 8.5]
    best, last = packing.priced(values, 20)
    want = max(a * 3 + b * 6 + c * 8.5 for a in range(7) for b in range(5) for c in range(3) if 3 * a + 5 * b + 8 * c <= 20)
    assert best[20] == want and sum(k * n for k, n in packing._filled(last, 20).items()) <= 20


@pytest.mark.parametrize("seed", [1, 2])
def test_packing_by_length(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 5000).astype(int) + 1, 1024)
    demand = np.bincount(lengths, minlength=1025)
    packed = packing.pack(demand, 1024)
    seen = np.zeros(1025, int)
    for n, content in packed.groups:
        assert n > 0 and sum(k * a for k, a in content) <= 1024
        for k, a in content:
            seen[k] += n * a
    assert (seen == demand).all() and packed.sequences <= -(-int(lengths.sum()) // 1024) + 1
    for demand in (np.zeros(9, int), np.array([0, 0, 0, 0, 0, 0, 3, 0, 2])):
        assert packing.pack(demand, 8).sequences == demand[5:].sum()


def test_hypergeometric(spark):
    df = spark.range(4000).select(
        mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(25), (F.col("id") + 0.5) / 4000).alias("x"),
        mixing.hypergeometric(F.lit(10), F.lit(10), F.lit(4), F.lit(0.3)).alias("all"),
        mixing.hypergeometric(F.lit(10), F.lit(0), F.lit(4), F.lit(0.99)).alias("none"),
    )
    got = np.array(df.collect())
    assert (got[:, 1] == 4).all() and (got[:, 2] == 0).all()
    assert abs(got[:, 0].mean() - 10) < 0.01 and abs(got[:, 0].var() - 25 * 0.4 * 0.6 * 25 / 49) < 0.05


def test_quotas_stay_exact(spark):
    quotas = [(0, 100), (1, 37), (2, 0), (3, 1)]
    got = mixing.split(spark.createDataFrame(quotas, "place int, quota long")).collect()
    for place, quota in quotas:
        assert sum(r.quota for r in got if r.place == place) == quota and all(r.quota >= 0 for r in got)
    shard = [sum(r.quota for r in got if r.shard == s) for s in range(16)]
    assert sum(shard) == 138 and max(shard) - min(shard) <= 1


def test_contexts_find_more_identifiers(spark):
    """`reach me at` stands before addresses; what else stands there is found, other words with digits aren't."""
    texts = [f"please reach me at user{i}@mail.com today and page {i}77777 of it" for i in range(12)]
    texts += ["please reach me at bob77[at]corp today", "see part 12345x for more", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(df).collect()}
    at = texts[12].index("bob77")
    assert got[12].spans == f"email:{at}:{at + len('bob77[at]corp')}" and got[12].n_found == 1 and got[12].n_email == 0
    assert all(r.n_found == 0 for i, r in got.items() if i != 12)


def test_parts_are_reported_in_company(spark):
    far = " word" * 60
    texts = ["login: alice then auth=Zx81kfqq", "auth=Zx81kfqq", "login: alice" + far + " auth=Zx81kfqq", "https://a.example/x token=abcdef99"]
    got = {r.doc_id: r for r in secrets.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_linked for i in range(4)] == [2, 0, 0, 1]
    assert got[0].spans == "identifier:0:12,weak:18:31" and got[3].spans.startswith("endpoint:0:19,assign:20:")


def test_machine_learns_pairs():
    """Two terms that are toxic only together, which no sum of weights for each can tell."""
    rng = random.Random(5)
    docs, labels = [], []
    for _ in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        noise = [f"w{rng.randrange(40)}" for _ in range(6)]
        docs.append(toxicity.terms(" ".join(noise + ["slur"] * a + ["group"] * b).encode()))
        labels.append(int(a and b))
    model = toxicity.train(docs, labels, [1.0] * len(docs))
    table = model.rows()
    score = lambda text: model.score(np.array([r for r in table[toxicity.terms(text)] if r >= 0], int))
    assert score(b"slur group w1") > 0.5 > max(score(b"slur w1"), score(b"group w1"), score(b""))


def test_bands(spark):
    """Junk goes though a heavy source is full of it, its group is small or has nothing else, or the text is short."""
    rng = random.Random(6)
    rows = []

    def add(kind, lang, script, source, n, chars, tokens=400, byte_share=0.0):
        for _ in range(n):
            x = chars + rng.uniform(-0.1, 0.1)
            rows.append((kind, False, script, lang, tokens, x, byte_share, 0.7, x, source))

    for k in range(6):
        add("clean", "en", "LATIN", f"s{k}", 100, 3.0)
        add("clean", "ru", "CYRILLIC", f"s{k}", 50, 1.5)
    add("short clean", "en", "LATIN", "s1", 20, 2.8, 30)
    add("hot junk", "en", "LATIN", "hot", 400, 1.2)
    add("small junk", "xx", "LATIN", "s2", 10, 1.2)
    add("junk only", "en", "NONE", "hot", 300, 1.1)
    add("unexpected script", "en", "CYRILLIC", "hot", 20, 0.4, byte_share=0.9)
    add("short junk", "en", "LATIN", "s3", 20, 0.8, 50, 0.7)
    schema = "kind string, base_failed boolean, script string, lang string, n_tokens long, chars_per_token double, byte_share double, " \
        "entropy double, wide_chars_per_token double, source string"
    got = quality.judge(spark.createDataFrame(rows, schema)).groupBy("kind").agg(F.min("kept").alias("all"), F.max("kept").alias("any")).collect()
    assert {r.kind: (r["all"], r["any"]) for r in got} == {
        k: (c, c) for c, ks in ((True, ("clean", "short clean")), (False, ("hot junk", "small junk", "junk only", "unexpected script", "short junk"))) for k in ks
    }
