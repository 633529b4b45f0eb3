import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from candlewick.llm import common, disclosure, minhash, packing, quality, registry  # noqa: E402


def test_registered():
    q = __spark_entry__.queries()
    assert all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 11)) and "pipeline" in q
    assert set(registry.SQL) <= set(registry.QUERIES)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, now = docs.columns, docs
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = common.materialise(stage(spark, now, sf_dir), name)
        assert now.columns == columns
        if name == "quality_rules":
            assert {r.doc_id for r in now.collect()} == good
            groups = {r.doc_id: r.group_id for r in minhash.group(now).collect()}
        if name == "near_dedup":
            kept = [r.doc_id for r in now.collect()]
            assert len(kept) == len(set(groups.values())) == len({groups[k] for k in kept})
        if name == "pii":
            assert sorted(r.doc_id for r in now.collect()) == sorted(kept)
            assert disclosure.find(now).where("size(base.email) + size(base.ip) + size(base.card) > 0").count() == 0
            texts = {r.doc_id: r for r in now.collect()}
            assert all(len(r.text) == r.n_chars for r in texts.values())
    out = corpus_pipeline.run(spark, sf_dir).collect()
    w = packing.word_ids()
    assert {r.doc_id for r in out} == set(kept)
    for r in out:
        ids = np.frombuffer(w.encode([texts[r.doc_id].text])[0] + bytes(4), "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
    assert docs.collect() == []


def test_odd_rows(spark, sf_dir):
    docs = spark.createDataFrame([(None, None, None, None, None), (None, "x@y.z " * 60, "en", "s", 1), (5, "", None, None, 0),
                                  (5, "", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
    assert docs.columns[:2] == ["doc_id", "piece"]
