"""Data-quality operators. Each returns the offending rows: zero rows = pass
(Q01-Q10, J04, A05-A07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import (
    FRESHNESS_ERROR_MINUTES, FRESHNESS_WARN_MINUTES, FUTURE_TOLERANCE_MINUTES, MAX_FEED_STALENESS_MINUTES, as_of_col,
)
from candlewick.functions.timeutil import epoch_seconds


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Distinct values outside the accepted list, with their counts (NULLs ignored)."""
    return (df.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").isin(list(values))))


def orphans(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent row and how many rows hold them (NULL keys
    ignored). Keys are counted before the join (partial aggregation), so a hot
    key is one row by then."""
    child = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("from_field")).agg(
        F.count(F.lit(1)).alias("n_records"))
    keys = parent.select(F.col(field).alias("from_field"))
    return child.join(keys, "from_field", "left_anti")


def relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key has no parent row (NULL keys ignored)."""
    lost = orphans(df, col, parent, field).select("from_field")
    return df.select(F.col(col).alias("from_field")).join(lost, "from_field", "left_semi")


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Out-of-range values (inclusive bounds, NULLs pass) with occurrence counts."""
    c = F.col(col)
    return (df.filter(c.isNotNull() & ((c < lo) | (c > hi))).groupBy(c.alias("invalid_value"))
            .agg(F.count(F.lit(1)).alias("occurrences")))


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key combinations occurring more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def assert_fresh(df: DataFrame, ts_col: str = "ingestion_ts", minutes: int = MAX_FEED_STALENESS_MINUTES,
                 as_of=None) -> DataFrame:
    """Zero or one row: the table is empty or its newest row is older than ``minutes``."""
    at = as_of_col(as_of)
    last = df.agg(F.max(ts_col).alias("last_ingestion_ts"))
    return (last.filter(F.col("last_ingestion_ts").isNull()
                        | (F.col("last_ingestion_ts") < at - F.make_dt_interval(mins=F.lit(minutes))))
            .select("last_ingestion_ts", at.alias("checked_at"),
                    (epoch_seconds(at) - epoch_seconds("last_ingestion_ts")).try_cast("int").alias("staleness_seconds")))


def assert_ohlc(df: DataFrame, open_col: str = "open_price", high_col: str = "high_price",
                low_col: str = "low_price", close_col: str = "close_price",
                keys: Sequence[str] = ("ticker", "window_start")) -> DataFrame:
    """Incoherent bars: high < low, high below open/close, or low above open/close."""
    o, h, lo, c = (F.col(x) for x in (open_col, high_col, low_col, close_col))
    bad = (h < lo) | (h < F.greatest(o, c)) | (lo > F.least(o, c))
    return df.filter(bad).select(*keys, open_col, high_col, low_col, close_col)


def assert_no_future(df: DataFrame, ts_col: str = "quote_ts", as_of=None,
                     tolerance_minutes: int = FUTURE_TOLERANCE_MINUTES,
                     cols: Sequence[str] = ("ticker", "quote_ts", "ingestion_ts", "source")) -> DataFrame:
    """Rows stamped later than as_of + tolerance (a time-zone bug signal)."""
    at = as_of_col(as_of)
    return df.filter(F.col(ts_col) > at + F.make_dt_interval(mins=F.lit(tolerance_minutes))).select(*cols)


def freshness(df: DataFrame, ts_col: str = "ingestion_ts", warn_minutes: int = FRESHNESS_WARN_MINUTES,
              error_minutes: int = FRESHNESS_ERROR_MINUTES, as_of=None, by: Sequence[str] = ()) -> DataFrame:
    """Source freshness with warn / error levels, overall or per group."""
    at = as_of_col(as_of)
    g = df.groupBy(*by) if by else df.groupBy()
    last = g.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (epoch_seconds(at) - epoch_seconds("max_loaded_at")).cast("long")
    return last.select(
        *by, "max_loaded_at", at.alias("snapshotted_at"), age.alias("age_seconds"),
        F.when(F.col("max_loaded_at").isNull() | (age > error_minutes * 60), "error")
        .when(age > warn_minutes * 60, "warn").otherwise("pass").alias("status"))
