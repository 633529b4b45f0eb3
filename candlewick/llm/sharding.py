"""Sharding by proportional stratified interleaving.

Every source's rows are put in a seeded random order and ranked; the fractional
rank ``(rank + 0.5) / rows of the source`` spreads each source evenly over
[0, 1). Sorting all rows by it and cutting the order into equal runs gives
shards that all hold the mixture of the whole table.

Ranks are distributed. Inside a source, rows are counted per bucket of their
hash, the counts get a prefix sum, and rows are numbered inside their bucket only:
no task ever holds a whole source, and a bucket holds about ``bucket_rows`` rows.
The order of all rows by fraction is a range sort whose ties go by the hash, so
that equal fractions (the one row of every small source, say) are spread as well;
its partitions are counted and numbered in turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import numbered, table, without

SEED = 20240131
SHARDS = 40
BUCKET_ROWS = 2_000
ROW_OVERHEAD_BYTES = 16


def _ranked(df: DataFrame, stratum: list[str], bucket: str, order: list[str]) -> DataFrame:
    """Number the rows of each stratum from 0 in the order (bucket, order...) as
    ``__rank``, with the stratum's row count as ``__size``."""
    counts = df.groupBy(*stratum, bucket).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*stratum)
    run = w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *(F.col(c).alias(f"__{c}") for c in [*stratum, bucket]),
        F.coalesce(F.sum("__n").over(run), F.lit(0)).alias("__before"),
        F.sum("__n").over(w).alias("__size"))
    on = None
    for c in [*stratum, bucket]:
        e = F.col(c).eqNullSafe(F.col(f"__{c}"))
        on = e if on is None else on & e
    inside = Window.partitionBy(*stratum, bucket).orderBy(*order)
    numbered = df.withColumn("__i", F.row_number().over(inside) - 1)
    return (numbered.join(offsets, on)
            .withColumn("__rank", F.col("__before") + F.col("__i"))
            .drop("__i", "__before", *(f"__{c}" for c in [*stratum, bucket])))


def interleave(df: DataFrame, stratum: str, keys: list[str], shards: int = SHARDS, seed: int = SEED,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``shard`` (0..shards-1) and ``slot`` (gapless from 0 in its shard).

    ``keys`` are the columns whose seeded hash gives the random order; rows
    equal in all of them are interchangeable. Law: shard row counts differ by
    at most one. A null stratum is a stratum of its own; null keys hash like any
    value; an empty table stays empty; input columns all stay, but those named
    ``shard`` or ``slot`` are replaced.
    """
    df = without(df, "shard", "slot")
    n = df.count()
    buckets = max(1, -(-n // bucket_rows))
    u = F.xxhash64(F.lit(seed), *keys)
    d = (df.withColumn("__u", u)
         .withColumn("__b", F.shiftrightunsigned(F.col("__u"), 33) % buckets))
    # Buckets of the shuffled order: any function of the hash will do, as long
    # as the order is (bucket, hash).
    d = d.withColumn("__stratum", F.col(stratum))
    d = _ranked(d, ["__stratum"], "__b", ["__u", *keys])
    d = d.withColumn("__f", (F.col("__rank") * 2 + 1) / (F.col("__size") * 2)).drop("__rank", "__size", "__b")
    d, _ = numbered(d.orderBy("__f", "__u", "__stratum", *keys), "interleaved", "__pos")
    q, r = divmod(n, shards)
    # The first r shards hold q + 1 rows, the others q.
    big = r * (q + 1)
    shard = F.when(F.col("__pos") < big, F.expr(f"__pos div {q + 1}"))
    if q:
        shard = shard.otherwise(F.expr(f"{r} + (__pos - {big}) div {q}"))
    start = F.when(F.col("shard") <= r, F.col("shard") * (q + 1)).otherwise(F.lit(big) + (F.col("shard") - r) * q)
    return (d.withColumn("shard", shard.cast("int"))
            .withColumn("slot", (F.col("__pos") - start).cast("long"))
            .drop("__u", "__stratum", "__f", "__pos"))


def op1_proportional_interleave(spark, sf_dir) -> DataFrame:
    """Shards 0 to 39 over all documents, law ``rows``."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    s = interleave(d, "source", ["doc_id", "text_crc32", "size"])
    return s.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "source")
