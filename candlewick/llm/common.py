"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.config import scratch_path

# Fixed value: the ASCII white space that separates words in every contract.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back: cuts the
    lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body(column)`` many times,
    whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names (in any case): they are about to be
    replaced by results of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


PART_BITS = 33  # of monotonically_increasing_id: partition above, row below


def numbered(rows: DataFrame, name: str = "sequences", out: str = "number") -> tuple[DataFrame, int]:
    """The rows, written, with ``out`` gapless from 0 in the order of the frame
    (of a sorted frame: its order); and their count.

    The row ids written with them are gapless inside each writing partition, so
    only one count per partition has to be summed."""
    kept = materialise(without(rows, out).withColumn("__uid", F.monotonically_increasing_id()), name)
    part = F.shiftright("__uid", PART_BITS)
    counts = materialise(kept.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")), "counts")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    joined = kept.withColumn("__part", part).join(first, "__part")
    low = F.col("__uid").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return joined.withColumn(out, F.col("__first") + low).drop("__part", "__first", "__uid"), total


def portions(batch: pa.RecordBatch, column: int, rows: int = 500, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``rows`` rows and, but for single longer
    texts, about ``size`` bytes in the column: keeps work arrays small."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        fit = int(np.searchsorted(np.cumsum(lengths[at:at + rows]), size))
        end = min(at + max(1, fit), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, for use inside tasks."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)
