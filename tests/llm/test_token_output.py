import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from candlewick.llm import packing, token_output  # noqa: E402


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 256, 1000, 4097])
def test_permutation(n):
    p = token_output.permute(np.arange(n), n, 1)
    assert sorted(p.tolist()) == list(range(n))
    if n > 100:
        assert (p != token_output.permute(np.arange(n), n, 2)).mean() > 0.9
        assert abs(np.corrcoef(p, np.arange(n))[0, 1]) < 0.2
        assert (token_output.permute(np.arange(n)[::-1], n, 1)[::-1] == p).all()


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = token_output.op9_feistel_shards(spark, sf_dir, shard_rows=50).collect()
    assert sorted(r.slot for r in out) == list(range(len(out)))
    assert {(r.shard, r.position) for r in out} == {divmod(s, 50) for s in range(len(out))} and len({r.shard for r in out}) > 3
    w = packing.word_ids()
    ids = {d: np.frombuffer(w.encode([t])[0] + bytes(4), "<u4").astype("<u2") for d, t in docs.items()}
    held = {d: [] for d in docs}
    for r in out:
        assert [p.offset for p in r.pieces] == np.cumsum([0, *(p.length for p in r.pieces[:-1])]).tolist()
        assert r.length == sum(p.length for p in r.pieces)
        row = np.concatenate([ids[p.doc_id][p.start:p.start + p.length] for p in r.pieces])
        assert r.ids_crc32 == zlib.crc32(row.tobytes())
        for p in r.pieces:
            held[p.doc_id].append((p.start, p.length))
    for d, pieces in held.items():
        pieces.sort()
        assert [s for s, _ in pieces] == np.cumsum([0, *(n for _, n in pieces[:-1])]).tolist()
        assert sum(n for _, n in pieces) == len(ids[d])
    # Every task leaves one row that is not full.
    assert sum(r.length < token_output.SIZE for r in out) <= 8


def test_filled_rows(spark, frame, texts):
    out = token_output.filled(frame(texts).coalesce(1), size=8).collect()
    w = packing.word_ids()
    every = np.concatenate([np.frombuffer(x + bytes(4), "<u4") for x in w.encode(texts)])
    rows = [np.frombuffer(r.ids, "<u2") for r in out]
    assert (np.concatenate(rows) == every).all() and [len(r) for r in rows[:-1]] == [8] * (len(rows) - 1)
    clash = frame(["a"]).withColumnsRenamed({"word": "number", "source": "part"})
    rows, n = token_output.placed(clash.select("*", *(token_output.F.lit(x).alias(x) for x in ("shard", "position"))))
    assert n == 1 and rows.columns == ["doc_id", "text", "part", "number", "slot", "shard", "position"]


def test_resume(spark, frame, texts, tmp):
    rows, n = token_output.placed(packing.tokenise(frame(texts), size=8, dtype="<u2"), shard_rows=10)
    m = token_output.write(rows, n, tmp + "/t", size=8, shard_rows=10)
    assert [r["rows"] for r in m.orderBy("shard").collect()] == [10] * (n // 10) + [n % 10] * bool(n % 10)
    whole = {r.slot: bytes(r.ids) for r in token_output.read(m, tmp + "/t", size=8).collect()}
    assert whole == {r.slot: bytes(r.ids) for r in rows.collect()}
    part = token_output.read(m, tmp + "/t", size=8, first=13, last=27).collect()
    assert [r.slot for r in sorted(part)] == list(range(13, 27))
    assert all(whole[r.slot] == bytes(r.ids) for r in part)


def test_empty(spark, frame, tmp):
    rows, n = token_output.placed(token_output.filled(frame(["x"]).limit(0)))
    m = token_output.write(rows, n, tmp + "/t")
    assert n == 0 and m.collect() == [] and token_output.read(m, tmp + "/t").collect() == []


def test_chunk_caches_are_dropped_when_a_task_ends(spark, tmp_path, monkeypatch):
    left = str(tmp_path / "left")

    def words(path=None):
        w = packing.word_ids(path)

        class Watched:
            encode = staticmethod(w.encode)

            @staticmethod
            def forget():
                w.forget()
                with open(left, "w") as out:
                    out.write(str(len(w) + len(w.older)))
        return Watched

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(token_output, "word_ids", words)
    assert sum(len(r.pieces) for r in token_output.filled(docs).collect()) >= 50
    with open(left) as f:
        assert f.read() == "0"
