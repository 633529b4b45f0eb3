"""Stored schemas, type widening, compaction by file size, run artefacts."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, NullType, StringType, \
    TimestampNTZType

from candlewick.functions.widening import common_type, widen
from candlewick.plans.batch_run import artifact_summary
from candlewick.sources.tables import any_of, compact, compact_all, file_sizes, merge_into, schema_of, stored, write_table
from tests.helpers import rows


def test_lattice():
    i, l, f, d, s = IntegerType(), LongType(), FloatType(), DoubleType(), StringType()
    for a, b, c in ((i, l, l), (f, d, d), (i, f, d), (ByteType(), i, i), (DateType(), TimestampNTZType(), TimestampNTZType()),
                    (l, d, None), (s, i, None), (NullType(), s, s), (l, l, l), (DateType(), i, None)):
        assert common_type(a, b) == c == common_type(b, a), (a, b)


def _rows(spark, values, kind, day=1):
    at = dt.datetime(2024, 1, day, 1)
    return spark.createDataFrame([(f"t{day}-{n}", at, at, n, at.date(), v) for n, v in enumerate(values)],
                                 f"ticker string, quote_ts timestamp_ntz, ingestion_ts timestamp_ntz, kafka_offset long, "
                                 f"trading_date date, v {kind}")


def test_merge_widens_and_names_what_it_cannot(spark, tmp):
    p = tmp + "/t"
    merge_into(spark, _rows(spark, [1, 2], "int"), p)
    kept = {f: os.path.getmtime(f) for f in glob.glob(p + "/**/*.parquet", recursive=True)}
    merge_into(spark, _rows(spark, [2 ** 40], "long", 2), p)
    merge_into(spark, _rows(spark, [5], "int", 3), p)
    assert sorted(r.v for r in stored(spark, p).collect()) == [1, 2, 5, 2 ** 40]
    assert all(os.path.getmtime(f) == m for f, m in kept.items())         # the narrow file is read as it is
    with pytest.raises(TypeError, match="v: bigint and string"):
        merge_into(spark, _rows(spark, ["x"], "string", 4), p)
    assert stored(spark, p).count() == 4
    with pytest.raises(TypeError, match="v: "):
        widen(_rows(spark, [1], "int").schema, _rows(spark, ["x"], "string").schema)


def test_reading_back_opens_no_footer(spark, tmp):
    p = tmp + "/t"
    write_table(_rows(spark, [1], "int"), p, ["trading_date"])
    assert schema_of(spark, p)["v"].dataType == IntegerType()
    # A file that is no Parquet would fail a merge of footers; planning does not look.
    os.makedirs(p + "/trading_date=2024-02-01")
    with open(p + "/trading_date=2024-02-01/part-0.parquet", "wb") as f:
        f.write(b"no parquet")
    assert stored(spark, p).filter("trading_date = DATE'2024-01-01'").count() == 1


def test_compaction_leaves_large_files_and_other_days(spark, tmp):
    p = tmp + "/t"
    df = spark.range(30_000).select((F.col("id") % 3).cast("int").alias("d"), "id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    df.filter("d = 0").repartition(12).write.partitionBy("d").parquet(p)
    df.filter("d = 1").coalesce(1).write.mode("append").partitionBy("d").parquet(p)
    df.filter("d = 2").repartition(2).write.mode("append").partitionBy("d").parquet(p)   # two files, neither small
    before = {r.file: r["size"] for r in file_sizes(spark, p, ["d"]).collect()}
    target = 2 * min(s for f, s in before.items() if "d=2" in f) - 1
    assert compact(spark, p, "d", target) == 12
    after = {r.file: r["size"] for r in file_sizes(spark, p, ["d"]).collect()}
    assert {f for f in before if "d=0" not in f} <= after.keys() and not any(f in after for f in before if "d=0" in f)
    assert 1 <= sum("d=0" in f for f in after) <= 3
    assert rows(stored(spark, p).select("d", "id", "h")) == rows(df)
    assert compact(spark, p, "d", target) == 0
    assert compact_all(spark, {p: ["d"]}) == {p: 2}                       # two files of d=2 are small for the default size
    q = tmp + "/plain"
    spark.range(100).repartition(7).write.parquet(q)
    assert compact(spark, q) == 7 and compact(spark, q) == 0 and stored(spark, q).count() == 100


def test_many_partitions_make_a_shallow_predicate(spark):
    terms = [F.col("id") == i for i in range(900)]
    assert spark.range(2000).filter(any_of(terms)).count() == 900


def test_artifacts(spark, tmp):
    def put(layer, name, results, elapsed):
        os.makedirs(f"{tmp}/{layer}", exist_ok=True)
        with open(f"{tmp}/{layer}/{name}.json", "w") as f:
            json.dump({"results": [{"unique_id": u, "status": s} for u, s in results], "elapsed_time": elapsed}, f)
    put("silver", "a", [("model.x", "success"), ("test.a", "pass"), ("test.b", "warn")], 1.234)
    put("silver", "b", [("test.c", "error"), ("seed.y", "success")], 2.0)
    put("empty", "a", [], 0.5)
    got = {r.layer: r for r in artifact_summary(spark, {x: f"{tmp}/{x}" for x in ("silver", "gold", "empty")}).collect()}
    s, total = got["silver"], got["total"]
    assert (s.models, s.seeds, s.tests_pass, s.tests_fail, s.tests_warn, s.errors, s.elapsed_seconds, s.status, s.ran) == (
        1, 1, 1, 1, 1, 1, 3.23, "falha", True)
    assert (got["gold"].ran, got["gold"].status, got["gold"].tests_pass) == (False, "not run", 0)
    assert (got["empty"].ran, got["empty"].status, got["empty"].elapsed_seconds) == (True, "ok", 0.5)
    assert (total.elapsed_seconds, total.status, total.ran, total.errors) == (3.73, "falha", False, 1)
    none = {r.layer: r for r in artifact_summary(spark, {"gold": f"{tmp}/gold"}).collect()}
    assert none["total"].status == "ok" and none["total"].elapsed_seconds == 0.0
