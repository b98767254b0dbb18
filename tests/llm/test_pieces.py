"""SentencePiece encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import pieces
from wakeline.llm.registry import queries, vocabulary

MODEL = vocabulary("piece_bpe_32k.model")
ODD = [
    None, "", " ", "▁", "▁▁a", "\n", "\n a", " a ", "a" * 300, "aaab" * 70, "<s></s><unk><0x0A>", "日本語 テスト 🙂🙂 x\x00y", "\t\r\n\t", "é ﬁ Ⅷ",
    *(" " * k + "a" + " " * (40 - k) for k in range(40)),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(library, texts):
    ids, at = pieces.pieces(MODEL).encode(texts)
    want = library.encode([t or "" for t in texts], add_eos=True, num_threads=1)
    for k, w in enumerate(want):
        got = ids[at[k] : at[k + 1]]
        assert got.tolist() == w, texts[k]
        assert pieces.pieces(MODEL).decode(got).decode() == library.decode(w), texts[k]


def test_odd_texts_encode_as_the_library_does(library):
    check(library, ODD)


def test_glued_words_encode_as_the_library_does(library, spark):
    rng = random.Random(5)
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    words = " ".join(texts).split()
    check(library, ["".join(rng.choice(words)[: rng.randint(1, 8)] for _ in range(rng.randint(1, 60))) for _ in range(400)])
    check(library, ["".join(rng.choice(" ▁\naeinorst.,-é日🙂") for _ in range(rng.randint(0, 80))) for _ in range(2000)])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_as_the_library_does(t):
    check(sentencepiece.SentencePieceProcessor(model_file=MODEL), [t.encode("utf-8", "replace").decode()])


def test_any_ids_decode_as_the_library_does(library):
    rng = random.Random(7)
    for ids in [[13466, 202, 2, 165], [2, 2, 259], [202, 165, 2]] + [[rng.choice([rng.randrange(260), rng.randrange(130, 260), rng.randrange(32_000)]) for _ in range(rng.randrange(10))] for _ in range(3000)]:
        assert pieces.pieces(MODEL).decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_the_cache_of_words_may_be_cleared_at_any_time(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 20)
    monkeypatch.setattr(pieces, "PORTION", 50)
    check(library, [f"word{k} other{k % 7} and more" for k in range(60)])


def test_columns_and_odd_rows(spark, odd_docs, no_docs, library):
    df = pieces.decode(pieces.encode(odd_docs.withColumnRenamed("slot", "Token_IDs"), MODEL), MODEL)
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids", "decoded"]
    for r in df.collect():
        assert r.token_ids == library.encode(r.text or "", add_eos=True) and r.decoded == (r.text or "")
    assert pieces.round_trip(no_docs, MODEL).collect() == []
    assert pieces.round_trip(odd_docs, MODEL).count() == odd_docs.count()
    assert pieces.round_trip(odd_docs.selectExpr("concat('k', doc_id) doc_id", "text"), MODEL).where("exact").count() == odd_docs.count()


def test_query_is_the_library_on_whole_texts(spark, library):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries()["op11_sentencepiece"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
