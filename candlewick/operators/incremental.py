"""Gold that follows a merge instead of being rebuilt.

A merged slice names the candles it can have changed. Those are aggregated again
from silver; where a candle really differs, every candle whose metrics look back
on it (``HALO`` candles of the same instrument and day) is recomputed from a
window that starts another ``HALO`` earlier. Only these rows are upserted, so
partitions without one keep their files. The snapshot reads a table of day states
(one row per instrument and day), of which only the touched days are aggregated
again.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.config import GOLD_LOOKBACK_DAYS, MARKET_TZ, as_of_col
from candlewick.functions.timeutil import bucket_start, interval_micros
from candlewick.operators.candles import DAY, gold_candles, ohlcv, with_lags, with_moving_metrics, with_returns
from candlewick.operators.common import lookback_filter, top1_per_key
from candlewick.operators.snapshot import latest_reading, snapshot_of
from candlewick.schemas import CANDLE_COLUMNS
from candlewick.sources.tables import materialize, merge_into, stored, touched_part, write_table

# The longest look-back of a candle's metrics: the volatility of 20 returns needs
# the close before the first of them.
HALO = 20
CANDLE_KEY = [*DAY, "window_start"]
BASE = ["open_price", "high_price", "low_price", "close_price", "n_ticks", "volume_cumulative", "avg_feed_delay_seconds",
        "source"]


def touched_buckets(slice_: DataFrame, bucket: str) -> DataFrame:
    """Candle keys that a slice of silver rows falls into."""
    return slice_.select(*DAY, bucket_start("quote_ts", bucket).alias("window_start")).distinct()


def candle_updates(silver: DataFrame, candles: DataFrame, touched: DataFrame, as_of=None, bucket: str = "1 minute",
                   digits: int = 4, sma_digits: int | None = None) -> DataFrame:
    """The candles that differ from the stored ones after silver rows of the
    ``touched`` keys (materialised) were merged."""
    if "quote_hour" in silver.columns and interval_micros("1 hour") % interval_micros(bucket) == 0:
        ticks = touched_part(silver, touched.withColumn("quote_hour", F.hour("window_start")), ["trading_date", "quote_hour"])
    else:
        ticks = touched_part(silver, touched, ["trading_date"])
    keyed = ticks.withColumn("window_start", bucket_start("quote_ts", bucket))
    new = ohlcv(keyed.join(touched, CANDLE_KEY, "left_semi").drop("window_start"), bucket)
    groups = touched.select(*DAY).distinct()
    old = touched_part(candles, touched, ["trading_date"]).join(groups, [*DAY], "left_semi").select(*CANDLE_KEY, *BASE)
    both = old.select(*CANDLE_KEY, F.struct(*BASE).alias("o")).join(
        new.select(*CANDLE_KEY, F.struct(*BASE).alias("n")), CANDLE_KEY, "full")
    differs = F.col("n").isNotNull() & ~F.col("o").eqNullSafe(F.col("n"))
    kept = F.coalesce("n", "o")
    base = both.select(*CANDLE_KEY, *(kept[c].alias(c) for c in BASE), differs.cast("int").alias("__differs"))
    day = Window.partitionBy(*DAY).orderBy("window_start")
    base = base.withColumn("__affected", F.max("__differs").over(day.rowsBetween(-HALO, 0)))
    base = base.withColumn("__needed", F.max("__affected").over(day.rowsBetween(0, HALO))).filter("__needed = 1")
    c = with_moving_metrics(with_returns(with_lags(base), digits), digits, sma_digits)
    return c.filter("__affected = 1").withColumn("refreshed_at", as_of_col(as_of)).select(*CANDLE_COLUMNS)


def refresh_candles(spark: SparkSession, silver: DataFrame, touched: DataFrame, path: str, as_of=None,
                    tz: str = MARKET_TZ, lookback_days: int | None = GOLD_LOOKBACK_DAYS, bucket: str = "1 minute",
                    digits: int = 4, sma_digits: int | None = None, by_hour: bool = False) -> int:
    """Bring the candle table at ``path`` up to date with silver rows merged under
    the ``touched`` keys; returns the number of candles written. Without a table
    it is built in full.

    Rows that did not change keep their ``refreshed_at``. Days before the look-back
    are left alone; readers filter them. ``by_hour`` partitions the table by day and
    hour, so a late tick rewrites the hours it reaches instead of the day."""
    parts = ["trading_date", "candle_hour"] if by_hour else ["trading_date"]
    hour = (lambda df: df.withColumn("candle_hour", F.hour("window_start"))) if by_hour else (lambda df: df)
    at = as_of_col(as_of)
    current = stored(spark, path)
    if current is None:
        full = gold_candles(silver, as_of, tz, lookback_days, bucket, digits, sma_digits)
        write_table(hour(full), path, parts)
        return stored(spark, path).count()
    touched = materialize(lookback_filter(touched, at, tz, lookback_days).select(*CANDLE_KEY).distinct(), "touched")
    updates = materialize(candle_updates(silver, current, touched, as_of, bucket, digits, sma_digits), "candle_updates")
    n = updates.count()
    if n:
        merge_into(spark, hour(updates), path, CANDLE_KEY, parts, [F.col("window_start")], "overwrite")
    return n


def log_changes(spark: SparkSession, touched: DataFrame, path: str) -> None:
    """Note keys that a merge is about to touch, until :func:`settle` is called."""
    touched.withColumn("change", F.lit(f"c{time.time_ns():020d}")).write.mode("append").partitionBy("change").parquet(path)


def pending_changes(spark: SparkSession, path: str) -> tuple[DataFrame | None, str | None]:
    """The keys noted and not yet settled, and the newest note among them. A gold
    layer that was stopped by a gate or a failure catches up from here."""
    log, settled = stored(spark, path), stored(spark, f"{path}.settled")
    if log is None:
        return None, None
    if settled is not None:
        done = settled.agg(F.max("change")).first()[0]
        log = log.filter(F.col("change") > F.lit(done)) if done else log
    return log.drop("change"), log.agg(F.max("change")).first()[0]


def settle(spark: SparkSession, path: str, change: str | None) -> None:
    """Gold holds all changes up to ``change``."""
    if change is not None:
        spark.createDataFrame([(change,)], "change string").write.mode("append").parquet(f"{path}.settled")


def day_states(silver: DataFrame) -> DataFrame:
    """Per instrument and day: its newest reading and its number of ticks."""
    newest = top1_per_key(silver, DAY, latest_reading())
    n = silver.groupBy(*DAY).agg(F.count(F.lit(1)).alias("n_ticks_dia"))
    return newest.join(n, [*DAY])


def refresh_day_states(spark: SparkSession, silver: DataFrame, touched: DataFrame | None, path: str, as_of=None,
                       tz: str = MARKET_TZ, lookback_days: int | None = GOLD_LOOKBACK_DAYS) -> None:
    """Bring the day states at ``path`` up to date with silver rows merged under
    the ``touched`` keys (None: build them in full)."""
    at = as_of_col(as_of)
    if touched is None or stored(spark, path) is None:
        write_table(day_states(lookback_filter(silver, at, tz, lookback_days)), path, ["trading_date"])
        return
    touched = materialize(lookback_filter(touched, at, tz, lookback_days).select(*DAY).distinct(), "touched_days")
    rows = touched_part(silver, touched, ["trading_date"]).join(touched, [*DAY], "left_semi")
    merge_into(spark, day_states(rows), path, DAY, "trading_date", latest_reading(), "overwrite")


def snapshot_from_states(states: DataFrame, candles: DataFrame, dim: DataFrame, as_of=None, tz: str = MARKET_TZ,
                         lookback_days: int | None = GOLD_LOOKBACK_DAYS, digits: int = 4) -> DataFrame:
    """The snapshot from day states: equal to the one taken from all silver rows."""
    days = lookback_filter(states, as_of_col(as_of), tz, lookback_days)
    return snapshot_of(top1_per_key(days, ["ticker"], latest_reading()), candles, dim, as_of, digits)
