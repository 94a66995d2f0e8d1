import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscan.llm import bpe, tokens


@pytest.fixture(scope="module")
def model():
    return bpe.load(bpe.tokenizer_file("byte_bpe_50k"))


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def rows(model, texts):
    ids, at = model.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


TEXTS = [
    "", " ", "a" * 1001, "ab" * 300, "the quick  brown fox's\n\n  jumps", "<|endoftext|> is text here", "保险金额为2024年3月，比例12.5％。", "Société Générale – été",
    "👩‍👩‍👧‍👦🙂", "\u200b\u00a0\u3000x", "0123456789" * 50, "''''''\"\"", "ﬁ①Ⅷ", "\r\n\t \n",
]


def test_equals_public_encoder(model, reference):
    rng = random.Random(5)
    pools = [(0x20, 0x7F), (0xA0, 0x24F), (0x4E00, 0x9FFF), (0x3040, 0x30FF), (0x400, 0x4FF), (0x1F300, 0x1F6FF)]
    made = ["".join(chr(rng.randint(*rng.choice(pools))) for _ in range(rng.randint(1, 80))) for _ in range(300)]
    assert rows(model, TEXTS + made) == reference(TEXTS + made)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
def test_encode_count_decode(model, reference, texts):
    ids, at = model.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == reference(texts)
    assert model.count(texts).tolist() == np.diff(at).tolist()
    assert model.decode(ids, at) == texts


def test_multilingual_ranks_equal_tiktoken():
    import base64

    import public_tokenizers as P
    import tiktoken

    path = bpe.tokenizer_file("byte_bpe_multi_50k")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert rows(bpe.load(path), TEXTS) == [theirs.encode_ordinary(t) for t in TEXTS]


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "  ", None), (4, "hello world", "x"), (4, "hello world", "x")], "doc_id long, text string, ids string")
    out = {(r.doc_id): list(r.ids) for r in tokens.token_ids(df).collect()}
    assert out[1] == [] and out[2] == [] and out[3] != [] and len(out[4]) == 2
    counts = {r.doc_id: r.n_tokens for r in tokens.token_counts(df).collect()}
    assert counts == {k: len(v) for k, v in out.items()}
    back = {r.doc_id: r.text for r in tokens.decode_ids(tokens.token_ids(df)).collect()}
    assert back == {1: "", 2: "", 3: "  ", 4: "hello world"}
    assert tokens.token_ids(df.limit(0)).count() == 0


def test_budget_totals(spark):
    sized = spark.createDataFrame([("d", "a", "zh", 1, 2, 3), ("d", "a", "en", 1, 2, 4), ("d", "b", "en", 2, 1, 5)], "collection string, source string, lang string, n_docs long, n_chars long, n_tokens long")
    got = {(r.source, r.lang, r.grouping_level): r.n_tokens for r in tokens.token_budget(sized, ["source", "lang"], ["collection"]).collect()}
    assert got[None, None, 3] == 12 and got["a", None, 1] == 7 and got[None, "en", 2] == 9 and got["b", "en", 0] == 5
    assert len(got) == 3 + 2 + 2 + 1


def test_corpus_budget_counts_copies_once(spark):
    docs = spark.createDataFrame([(1, "hello", "EN-us", "Src-A ", "d1"), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, index_doc_id string")
    chunks = spark.createDataFrame([("c1", "d1", "保险"), ("c1", "d1", "保险"), ("c2", "dx", None)], "chunk_id string, doc_id string, text string")
    index = spark.sql("select 'd1' doc_id, 'Old' domain, timestamp_ntz'2026-01-01' indexed_at union all select 'd1', 'Insurance', timestamp_ntz'2026-02-01' union all select 'd1', null, timestamp_ntz'2026-03-01'")
    got = {(r.collection, r.source, r.lang, r.domain): r.n_docs for r in tokens.corpus_budget(docs, chunks, index).where("grouping_level = 0").collect()}
    assert got == {("documents", "src_a", "en", "insurance"): 1, ("documents", "unknown", "und", "unknown"): 1, ("chunks", "chunks", "zh", "insurance"): 1, ("chunks", "chunks", "und", "unknown"): 1}


def test_language_of_chunks(spark):
    texts = {"保险 ABC": "zh", "The rate of the bond, and its term": "en", "Le taux de la dette et les frais": "fr", "XYZ 12": "und", "": "und", None: "und", "theory often": "und"}
    df = spark.createDataFrame([(t, w) for t, w in texts.items()], "t string, want string")
    assert [r.t for r in df.withColumn("got", tokens.text_language(df.t)).where("got != want").collect()] == []


def test_counts_keep_no_ids(model):
    fresh = bpe.load.__wrapped__(bpe.tokenizer_file("byte_bpe_50k"))
    texts = [None, "", " ", "甲乙丙丁，戊己庚辛。", "the 12 cats'll  \n\n go", "aaaaaaaaaaaaaaaaaaaaaaab" * 50, "é" * 70, "the 12 cats"]
    want = [len(ids) for ids in rows(model, texts)]
    assert fresh.count(texts).tolist() == want and fresh.count(texts[::-1]).tolist() == want[::-1]
    assert not fresh.known_ids and not fresh.place
    assert rows(fresh, texts) == rows(model, texts) and fresh.count(texts).tolist() == want
