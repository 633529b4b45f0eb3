import numpy as np
import pytest

from candlewick.llm import hamming


def brute(ids, words, queries, k):
    out = {}
    for q in queries:
        d = np.bitwise_count(words ^ words[ids.index(q)]).sum(axis=1)
        best = sorted((int(x), i) for x, i in zip(d, ids) if i != q)[:k]
        out[q] = [(r + 1, i, x) for r, (x, i) in enumerate(best)]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.neighbor_id, r.distance))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("width,copies,blocks", [(1, 0, 1 << 16), (1, 40, 50), (2, 10, 64)])
def test_against_brute_force(spark, monkeypatch, width, copies, blocks):
    monkeypatch.setattr(hamming, "BLOCK_CODES", blocks)
    monkeypatch.setattr(hamming, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(width + copies)
    centres = rng.integers(0, 1 << 63, (20, width), dtype=np.uint64)
    words = centres[rng.integers(0, 20, 300)]
    for _ in range(4):
        words = words ^ (np.uint64(1) << rng.integers(0, 64, (300, width), dtype=np.uint64))
    words[:copies] = words[0]
    ids = list(range(300))
    coded = spark.createDataFrame([(i, bytearray(w.tobytes())) for i, w in zip(ids, words)], "id long, code binary")
    got = answers(hamming.top_k(coded, coded.where("id % 5 = 0"), k=7))
    assert got == brute(ids, words, [i for i in ids if i % 5 == 0], 7)


def test_few_rows_nulls_and_repeats(spark):
    d = spark.createDataFrame([(1, [1.0, -1.0]), (2, [1.0, None]), (None, [1.0, 1.0]), (4, None), (5, [-1.0, float("nan")])],
                              "vec_id long, embedding array<float>")
    coded = hamming.codes(d, "vec_id", "embedding", 2)
    assert {r.id: bytes(r.code)[0] >> 6 for r in coded.collect()}.keys() == {1, 2, 5}
    got = answers(hamming.top_k(coded, coded))
    assert got[1][0] == (1, 2, 0) and len(got[5]) == 2
    assert hamming.top_k(coded.limit(0), coded.limit(0)).collect() == []
