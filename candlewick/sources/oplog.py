"""Operational records as JSON lines: alerts and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.schemas import RUN_RESULTS_SCHEMA
from candlewick.sources.tables import is_absent


def append_json(df: DataFrame, path: str) -> None:
    """Append records as JSON lines."""
    df.write.mode("append").json(path)


def tail_json(spark: SparkSession, path: str, schema: StructType, ts_col: str, n: int = 5,
              tie: Sequence[str] = ()) -> DataFrame:
    """Newest ``n`` records, newest first (``tie``: columns that order equal
    times, descending); corrupt lines are skipped; a missing log reads as empty."""
    try:
        df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as e:
        if not is_absent(e):
            raise
        df = spark.createDataFrame([], schema)
    return df.orderBy(F.col(ts_col).desc(), *(F.col(c).desc() for c in tie)).limit(n)


def results_files(spark: SparkSession, path: str) -> DataFrame:
    """Nested run-results JSON, one row per file."""
    return spark.read.schema(RUN_RESULTS_SCHEMA).option("multiLine", True).json(path)


def read_run_results(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """Nested run-results JSON -> one row per executed node."""
    out = results_files(spark, path).select(F.explode("results").alias("r"), "elapsed_time").select(
        "r.unique_id", "r.status", "r.execution_time", "elapsed_time")
    return out.withColumn("layer", F.lit(layer)) if layer else out
