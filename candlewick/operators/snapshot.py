"""Gold per-instrument snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import GOLD_LOOKBACK_DAYS, MARKET_TZ, as_of_col
from candlewick.functions.timeutil import epoch_seconds
from candlewick.operators.common import lookback_filter, top1_per_key
from candlewick.schemas import SNAPSHOT_COLUMNS


def latest_reading() -> list:
    return [F.col("ingestion_ts").desc(), F.col("kafka_offset").desc()]


def latest_tick(silver: DataFrame) -> DataFrame:
    """Last *ingested* reading per ticker (ingestion_ts, then kafka_offset).
    A late, older quote can therefore become the latest state."""
    return top1_per_key(silver, ["ticker"], latest_reading())


def latest_candle(candles: DataFrame) -> DataFrame:
    """Most recent candle per ticker with its moving metrics."""
    return top1_per_key(candles.select("ticker", "window_start", "sma_9", "sma_20", "volatility_pct_20"),
                        ["ticker"], [F.col("window_start").desc()])


def day_aggregate(silver: DataFrame) -> DataFrame:
    """Per (ticker, trading_date): tick count and max cumulative volume."""
    return silver.groupBy("ticker", "trading_date").agg(
        F.count(F.lit(1)).alias("n_ticks_dia"), F.max("volume").alias("volume_dia"))


def day_range_position(price, low, high, digits: int = 2):
    """Where the price sits in the day's range, in %; NULL when high <= low."""
    price, low, high = (F.col(x) if isinstance(x, str) else x for x in (price, low, high))
    return F.when(high > low, F.round((price - low) / (high - low) * 100, digits))


def ticker_snapshot(silver: DataFrame, candles: DataFrame, dim: DataFrame, as_of=None, tz: str = MARKET_TZ,
                    lookback_days: int | None = GOLD_LOOKBACK_DAYS, digits: int = 4) -> DataFrame:
    """One row per ticker seen in the lookback window (25 columns).

    The three joins are left joins on small per-ticker tables; Spark picks a
    broadcast only when their measured size allows it (AQE), otherwise a
    shuffle join. The day aggregate is restricted to the lookback first,
    which gives the same rows because the left side is already restricted.
    """
    ticks = lookback_filter(silver, as_of_col(as_of), tz, lookback_days)
    day = day_aggregate(ticks).drop("volume_dia")
    return snapshot_of(latest_tick(ticks).join(day, ["ticker", "trading_date"], "left"), candles, dim, as_of, digits)


def snapshot_of(latest: DataFrame, candles: DataFrame, dim: DataFrame, as_of=None, digits: int = 4) -> DataFrame:
    """The snapshot's columns for the latest reading of each ticker, which
    brings the tick count of its day (``n_ticks_dia``)."""
    at = as_of_col(as_of)
    candle = latest_candle(candles).withColumnRenamed("window_start", "last_candle_window")
    d = dim.select("ticker", "company_name", "sector", "b3_index")
    j = latest.join(d, "ticker", "left").join(candle, "ticker", "left")
    return j.select(
        "ticker", "company_name", "sector", "b3_index",
        F.col("price").alias("last_price"),
        "previous_close",
        F.round(F.col("price") - F.col("previous_close"), digits).alias("change_abs"),
        "change_pct", "day_open", "day_high", "day_low",
        day_range_position("price", "day_low", "day_high").alias("day_range_position_pct"),
        F.col("volume").alias("volume_cumulative"),
        "n_ticks_dia", "sma_9", "sma_20", "volatility_pct_20", "last_candle_window",
        F.col("quote_ts").alias("last_quote_ts"),
        F.col("ingestion_ts").alias("last_ingestion_ts"),
        "feed_delay_seconds",
        (epoch_seconds(at) - epoch_seconds("ingestion_ts")).try_cast("int").alias("seconds_since_last_tick"),
        "source",
        at.alias("refreshed_at"),
        "trading_date",
    ).select(*SNAPSHOT_COLUMNS)
