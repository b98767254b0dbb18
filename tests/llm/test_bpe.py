import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from wakeline.llm import bpe
from wakeline.llm.registry import op4_bpe, vocabulary


@pytest.fixture(scope="module")
def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_the_rank_based_encoder(spark, reference_encoding, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op4_bpe(spark, f"/root/testdata/sf{sf}").collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        ids = reference_encoding.encode_ordinary(text or "")
        assert got[k].n_tokens == len(ids) and got[k].exact
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a \n b", "don't I'LL", "é ‍  \u0085 x　y\x1c z", "<|endoftext|> a", "🙂 🙂🙂", "x" * 3000, " 1 2  3\t4", "퟿ \U0010ffff"])
def test_pieces_join_to_the_whole(text, reference_encoding):
    c = bpe.codec(vocabulary())
    ids = c.encode(text)
    assert ids == reference_encoding.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def test_columns_offsets_and_odd_rows(odd_docs, no_docs):
    rows = bpe.decode(bpe.encode(odd_docs, vocabulary()), vocabulary()).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode() and r.slot == "clash"
        if r.token_ids:
            assert r.starts[0] == 0 and r.ends[-1] == len(r.text)
            assert all(a < b for a, b in zip(r.starts, r.ends, strict=True))
    assert bpe.round_trip(no_docs, vocabulary()).count() == 0
    assert all(r.exact for r in bpe.round_trip(odd_docs, vocabulary()).collect())
