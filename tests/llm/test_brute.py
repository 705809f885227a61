"""Every query over the smallest tables against plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from changelake.llm import packing, queries
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()


def rows(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def test_pii(spark, docs):
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in rows(spark, "op1_pii")}
    for d in docs:
        found = brute.pii(d.text)
        assert got[d.doc_id][:5] == (*map(len, found.values()), brute.pii_sha(found))
        base = {f"{k}:{a}:{b}" for k, spans in found.items() for a, b in spans}
        assert base <= set(got[d.doc_id][5].split(",")) | {""}
    assert len(got) == len(docs)


def test_quality(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op2_fertility")}
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(d.text)
        assert not (r.kept and r.base_failed)
    assert len(got) == len(docs)


def test_language(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op3_language")}
    assert all(got[d.doc_id].held_out == (brute.crc(d.doc_id) % 4 == 2) for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) >= 0.95


def test_urls(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = rows(spark, "op4_url_rules")
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = brute.url(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.rule_confidence is not None else "allow"))


def test_simhash(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op5_simhash")}
    assert got == brute.simhash_groups([(d.doc_id, d.text) for d in docs])


def test_secrets(spark, docs):
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows(spark, "op6_secrets")}
    for d in docs:
        found = brute.secrets(d.text)
        assert got[d.doc_id] == (*map(len, found.values()), brute.secrets_sha(found))
    assert len(got) == len(docs)


def test_embeddings(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    want = brute.embedding_groups([(r.vec_id, r.embedding, r.label) for r in table])
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows(spark, "op7_embeddings")}
    assert got == want


def test_toxicity(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op8_toxicity")}
    assert len(got) == len(docs)
    assert all(r.held_out == (brute.crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in got.values())


def test_packing(spark, docs):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(dict)
    sequences = defaultdict(list)
    for r in rows(spark, "op9_packing"):
        pieces[r.doc_id][r.piece] = (r.start, r.length, r.ids_crc32)
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for d in docs:
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
        cut = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        total += len(ids)
        want = {k: (4096 * k, len(x), zlib.crc32(x.tobytes())) for k, x in enumerate(cut)}
        assert pieces[d.doc_id] == want
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-total // 4096) + 1


def test_word_ids_are_those_of_whole_texts():
    """Odd words, encoded one by one, as the tokenizer encodes the whole text."""
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    text = (
        "It's ΣΊΣΥΦΟΣ, İstanbul ﬁne… naïve. Å ÅÅ d'd 're x9y! ... \"q\". über,Straße; 漢字, <|endoftext|> a\u0301b é. "
        "e\u0301\u00a0x\u2003y\x1cz ½¾ ²3 ǅ ñandú!? \U0001f600. \U00010400x, ﷺ ß ẞ Ⅷ ⅷ. ʼn ŉ ÷a @b #c. ة.,"
    )
    plain = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    words = packing._words(path)
    for _ in range(2):
        assert np.frombuffer(packing.token_bytes(text.encode(), words), "<u4").tolist() == [*plain, 1]


def test_mixing(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op10_mixing")}
    sizes, took = Counter(), Counter()
    for d in docs:
        n = len(brute.words(d.text))
        sizes[d.source] += n
        assert got[d.doc_id].size == n and got[d.doc_id].taken in (0, n, 2 * n)
        took[d.source] += got[d.doc_id].taken
    targets = brute.targets(sizes)
    longest = Counter()
    for d in docs:
        r = got[d.doc_id]
        assert r.source_size == sizes[d.source] and r.target == pytest.approx(targets[d.source])
        longest[d.source] = max(longest[d.source], r.size)
    assert all(abs(took[s] - targets[s]) <= longest[s] / 2 + 1 for s in sizes)
    again = {r.doc_id: r for r in rows(spark, "op10_mixing")}
    assert again == got
