import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from candlewick.llm import byte_bpe  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(reference, text):
    ids = byte_bpe.coder().encode(text).tolist()
    assert ids == reference.encode_ordinary(text)
    assert byte_bpe.coder().decode(ids) == text.encode()


def test_texts(reference, texts):
    for t in texts:
        same(reference, t or "")
    for t in ("<|endoftext|>", " a  b   c ", "Ġ▁ĠĠ", "".join(map(chr, range(1, 700))), " " * 999 + "x", "a" * 20000):
        same(reference, t)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'slé1٣漢  \x85\x1c."), st.characters(codec="utf-8", max_codepoint=0x2FFFF)), max_size=40))
def test_random(reference, text):
    same(reference, text)


def test_small_cache(reference, monkeypatch, texts):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    for t in texts:
        same(reference, (t or "")[:300])


def test_query(spark, sf_dir, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = byte_bpe.op3_byte_bpe(spark, sf_dir).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_frame(frame, texts):
    out = byte_bpe.decode(byte_bpe.encode(frame(texts))).collect()
    assert [r.decoded.decode() for r in out] == [t or "" for t in texts]
    assert [r.word for r in out] == list(range(len(texts)))
    assert byte_bpe.encode(frame(texts).limit(0)).collect() == []
    assert byte_bpe.encode(frame(texts), out="Word").columns == ["doc_id", "text", "source", "Word"]
