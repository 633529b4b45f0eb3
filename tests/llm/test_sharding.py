import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from candlewick.llm import sharding


def check(rows, shards):
    """Law: counts differ by one at most, slots gapless; every source spreads evenly."""
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    n = len(rows)
    sizes = [len(by[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s in by:
        assert sorted(r["slot"] for r in by[s]) == list(range(len(by[s])))
    total = Counter(r["source"] for r in rows)
    for s, members in by.items():
        mine = Counter(r["source"] for r in members)
        for source, c in total.items():
            # A run of the interleaved order holds a source's share up to one row.
            assert abs(mine[source] - c * len(members) / n) <= 2, (s, source)


def test_query(spark, sf_dir):
    out = sharding.op1_proportional_interleave(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    check(out, 40)


def test_hot_source_many_buckets(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))
    out = sharding.interleave(d, "source", ["doc_id"], shards=11, bucket_rows=100).collect()
    check(out, 11)
    again = sharding.interleave(d.repartition(7), "source", ["doc_id"], shards=11, bucket_rows=100).collect()
    assert sorted(out) == sorted(again)
    # The order inside a shard is a shuffle, not the input's.
    first = [r.doc_id for r in sorted(out, key=lambda r: r.slot) if r["shard"] == 0]
    assert first != sorted(first)


@pytest.mark.parametrize("ids", [[None] * 7, [1] * 7, list(range(7))])
def test_nulls_ties_and_extra_columns(spark, ids):
    d = spark.createDataFrame([(i, None if k % 2 else "a", k) for k, i in enumerate(ids)], "doc_id long, source string, size long")
    out = sharding.interleave(d, "source", ["doc_id"], shards=3).collect()
    assert sorted(r["size"] for r in out) == list(range(7))
    assert sorted(Counter(r.shard for r in out).values()) == [2, 2, 3]


def test_empty_and_fewer_rows_than_shards(spark):
    d = spark.createDataFrame([], "doc_id long, source string")
    assert sharding.interleave(d, "source", ["doc_id"]).collect() == []
    d = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    assert sorted((r.shard, r.slot) for r in sharding.interleave(d, "source", ["doc_id"]).collect()) == [(0, 0), (1, 0)]
    clash = d.withColumns({"Slot": F.lit(9), "number": F.lit(2), "part": F.lit(3)})
    out = sharding.interleave(clash, "source", ["doc_id"])
    assert out.columns == ["doc_id", "source", "number", "part", "shard", "slot"]
    assert sorted(r.slot for r in out.collect()) == [0, 0]


def test_against_plain_ranks(spark):
    """The same order by two plain windows."""
    import duckdb
    d = spark.range(700).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 3 == 1, F.concat(F.lit("one"), F.col("id").cast("string"))).otherwise(
        F.concat(F.lit("s"), (F.col("id") % 9).cast("string"))).alias("source"))
    pdf = d.withColumn("u", F.xxhash64(F.lit(sharding.SEED), "doc_id")).withColumn(
        "b", F.shiftrightunsigned("u", 33) % 7).toPandas()  # noqa: F841 - read by name
    want = duckdb.sql("""
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY b, u, doc_id) - 1 AS rank,
                          count(*) OVER (PARTITION BY source) AS n FROM pdf),
        p AS (SELECT doc_id, row_number() OVER (ORDER BY (rank * 2 + 1) / (n * 2), u, source, doc_id) - 1 AS pos FROM r)
        SELECT doc_id, pos // 100 AS shard, pos % 100 AS slot FROM p""").fetchall()
    got = sharding.interleave(d, "source", ["doc_id"], shards=7, bucket_rows=100).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_one_row_sources_are_spread(spark):
    """All fractions are equal: the sort's ties go by the hash, over all tasks."""
    from candlewick.llm.common import numbered
    d = spark.range(0, 4000, 1, 4).withColumn("f", F.lit(0.5)).withColumn("u", F.xxhash64("id"))
    kept, n = numbered(d.repartitionByRange(4, "f", "u").sortWithinPartitions("f", "u"))
    rows = sorted(kept.collect(), key=lambda r: r.number)
    assert n == 4000 and [r.u for r in rows] == sorted(r.u for r in rows)
    assert [r.number for r in rows] == list(range(4000))
