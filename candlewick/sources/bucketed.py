"""Silver in buckets of its key, so that an upsert does not shuffle it.

The table lives in the catalog, partitioned by trading date and bucketed by
(ticker, quote_ts). A slice is written once into the same buckets; both sides of
the merge are then laid out alike, and the full outer join on the key reads the
target's touched partitions where they are: no exchange, whatever their size. A
hot instrument is spread over all buckets, because its quote times are part of
the key. Rows are written back by the tasks that joined them, a file per day and
bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import scratch_path
from candlewick.functions.widening import conform
from candlewick.operators.silver import SILVER_KEY, first_reading
from candlewick.sources.tables import touched_part

PARTITION = "trading_date"


def _in_buckets(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str]) -> None:
    # One task per bucket, so that a bucket's rows of a day are one file.
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .partitionBy(PARTITION).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def create_bucketed(spark: SparkSession, silver: DataFrame, name: str, path: str, buckets: int,
                    keys: Sequence[str] = SILVER_KEY) -> None:
    """Create the table ``name`` (``db.table``) of unique silver rows. The number of
    buckets stays with the table: choose it for the rows of a day, as a bucket of a
    day is one file."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    _in_buckets(silver, name, path, buckets, keys)


def _bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{name} is not bucketed")
    return int(rows[0]["data_type"])


def merged_buckets(target: DataFrame, source: DataFrame, keys: Sequence[str] = SILVER_KEY) -> DataFrame:
    """The rows of both sides, each unique on ``keys``: of a key on both, the
    reading that was seen first (the source's copy of the same one)."""
    cols = target.columns
    row = lambda df: F.struct(*(df[c] for c in cols))
    t = target.select(*keys, row(target).alias("t"))
    s = source.select(*keys, row(source).alias("s"))
    seen: list[Column] = [F.struct(F.col(f"{x}.ingestion_ts"), F.col(f"{x}.kafka_offset")) for x in ("s", "t")]
    first = F.when(F.col("t").isNull() | (F.col("s").isNotNull() & (seen[0] <= seen[1])), F.col("s")).otherwise(F.col("t"))
    return t.join(s.hint("merge"), [*keys], "full").select(first.alias("r")).select("r.*")


def merge_bucketed(spark: SparkSession, source: DataFrame, name: str, keys: Sequence[str] = SILVER_KEY) -> None:
    """First-wins upsert of silver rows into a bucketed table. Only the days the
    source touches are read and rewritten."""
    target = spark.table(name)
    buckets = _bucket_count(spark, name)
    path = scratch_path(spark, "bucketed_slice")
    staged = f"{name}_slice_{path.rsplit('-', 1)[-1]}"
    _in_buckets(first_reading(conform(source, target.schema), keys), staged, path, buckets, keys)
    try:
        slice_ = spark.table(staged)
        out = merged_buckets(touched_part(target, slice_, [PARTITION]), slice_, keys)
        # insertInto would not hand its options on, and so depend on the session's overwrite mode.
        spark.sql(f"INSERT OVERWRITE TABLE {name} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {{rows}}",
                  rows=out.select(*target.columns))
        spark.catalog.refreshTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
