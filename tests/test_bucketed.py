"""The bucketed silver table: same rows as the plain merge, no shuffle of the target."""

import glob
import os

from pyspark.sql import functions as F

from candlewick.config import scratch_path
from candlewick.operators.silver import merge_frames
from candlewick.sources.bucketed import _in_buckets, create_bucketed, merge_bucketed, merged_buckets
from tests.helpers import rows, silver_df


def _rows(spark, day, n, offset=0, hot="HOT"):
    return silver_df(spark, [dict(ticker=hot if i % 3 else f"T{i % 7}", quote_ts=f"2024-01-{day:02d} 13:{i % 60:02d}:{i // 60:02d}",
                                  ingestion_ts=f"2024-01-{day:02d} 14:{(i + offset) % 60:02d}:00", price=float(i + 1),
                                  event_id=f"{day}-{i}-{offset}", kafka_offset=i + offset) for i in range(n)])


def test_merge_equals_the_plain_one_and_does_not_shuffle_the_target(spark):
    name = "lake_buckets.silver_" + scratch_path(spark, "b").rsplit("-", 1)[-1]
    path = scratch_path(spark, "bucketed")
    old = _rows(spark, 2, 200).unionByName(_rows(spark, 3, 200))
    create_bucketed(spark, old, name, path, 4)
    kept = {f: os.path.getmtime(f) for f in glob.glob(path.replace("file:", "") + "/trading_date=2024-01-02/*.parquet")}
    new = _rows(spark, 3, 260, offset=-3).unionByName(_rows(spark, 4, 10))
    merge_bucketed(spark, new.unionByName(new.limit(5)), name)
    got = spark.table(name)
    assert rows(got.select(*old.columns)) == rows(merge_frames(old, new).select(*old.columns))
    assert {f: os.path.getmtime(f) for f in kept} == kept and len(kept) <= 4
    # Merging again changes nothing; the table is still in buckets.
    merge_bucketed(spark, new, name)
    assert rows(spark.table(name).select(*old.columns)) == rows(merge_frames(old, new).select(*old.columns))
    staged, where = name + "_plan", scratch_path(spark, "staged")
    _in_buckets(new, staged, where, 4, ("ticker", "quote_ts"))
    day = F.col("trading_date") == F.lit("2024-01-03").cast("date")
    plan = merged_buckets(spark.table(name).filter(day), spark.table(staged))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert max(r["count"] for r in spark.table(name).groupBy(F.expr("pmod(hash(ticker, quote_ts), 4)")).count().collect()) < 200
    spark.sql(f"DROP TABLE {staged}")
    spark.sql(f"DROP TABLE {name}")


def test_merge_does_not_depend_on_the_sessions_overwrite_mode(spark):
    name = "lake_buckets.silver_" + scratch_path(spark, "b").rsplit("-", 1)[-1]
    old, new = _rows(spark, 2, 20).unionByName(_rows(spark, 3, 20)), _rows(spark, 3, 30, offset=-3)
    create_bucketed(spark, old, name, scratch_path(spark, "bucketed"), 2)
    mode = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(mode)
    spark.conf.set(mode, "static")   # Spark's default
    try:
        merge_bucketed(spark, new, name)
        assert spark.conf.get(mode) == "static"
    finally:
        spark.conf.set(mode, was)
    assert rows(spark.table(name).select(*old.columns)) == rows(merge_frames(old, new).select(*old.columns))
    spark.sql(f"DROP TABLE {name}")
