"""Gold candles: OHLCV buckets and per-day window metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.config import GOLD_LOOKBACK_DAYS, MARKET_TZ, as_of_col
from candlewick.functions.timeutil import bucket_start
from candlewick.operators.common import lookback_filter
from candlewick.schemas import CANDLE_COLUMNS

DAY = ("ticker", "trading_date")


def ohlcv(ticks: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """One candle per (ticker, trading_date, bucket): first/last price by quote time,
    high, low, tick count, max cumulative volume, mean feed delay, max source.

    ``max(source)`` over all ticks would force a sort-based aggregate of the
    whole input (strings have no fixed-width buffer). The ticks are therefore
    hash-aggregated per source first; only the few rows per candle that remain
    are combined, with the plain string maximum.
    """
    keys = ["ticker", "trading_date", "window_start"]
    per_source = ticks.groupBy("ticker", "trading_date", bucket_start("quote_ts", bucket).alias("window_start"), "source").agg(
        F.min("quote_ts").alias("first_ts"), F.min_by("price", "quote_ts").alias("first_price"),
        F.max("quote_ts").alias("last_ts"), F.max_by("price", "quote_ts").alias("last_price"),
        F.max("price").alias("high"), F.min("price").alias("low"), F.count(F.lit(1)).alias("ticks"),
        F.max("volume").alias("volume"),
        F.sum(F.col("feed_delay_seconds").cast("long")).alias("delay"), F.count("feed_delay_seconds").alias("delays"))
    return per_source.groupBy(*keys).agg(
        F.min_by("first_price", "first_ts").alias("open_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.max_by("last_price", "last_ts").alias("close_price"),
        F.sum("ticks").alias("n_ticks"),
        F.max("volume").alias("volume_cumulative"),
        F.round(F.sum("delay") / F.nullif(F.sum("delays"), F.lit(0)), 1).alias("avg_feed_delay_seconds"),
        F.max("source").alias("source"))


def day_window() -> Window:
    """Every candle metric is scoped to one ticker and trading day."""
    return Window.partitionBy(*DAY).orderBy("window_start")


def with_lags(candles: DataFrame) -> DataFrame:
    """W04/W05 + P13: previous close, previous cumulative volume, volume delta (>= 0)."""
    w = day_window()
    return (candles
            .withColumn("prev_close_price", F.lag("close_price").over(w))
            .withColumn("prev_volume_cumulative", F.lag("volume_cumulative").over(w))
            .withColumn("volume_delta", F.greatest(
                F.coalesce(F.col("volume_cumulative") - F.col("prev_volume_cumulative"), F.lit(0).cast("long")),
                F.lit(0).cast("long"))))


def with_returns(candles: DataFrame, digits: int = 4) -> DataFrame:
    """Candle return in %, NULL unless the previous close is positive."""
    prev = F.col("prev_close_price")
    return candles.withColumn("return_pct", F.when(prev > 0, F.round((F.col("close_price") / prev - 1) * 100, digits)))


def with_moving_metrics(candles: DataFrame, digits: int = 4, sma_digits: int | None = None) -> DataFrame:
    """SMA-9, SMA-20 of closes and the sample stddev of the last 20 returns.

    Frames count existing candles (ROWS), so gaps are skipped and the first
    candles of a day average what exists. All three share one window spec:
    one shuffle, one sort.
    """
    sd = digits if sma_digits is None else sma_digits
    w = day_window()
    return (candles
            .withColumn("sma_9", F.round(F.avg("close_price").over(w.rowsBetween(-8, 0)), sd))
            .withColumn("sma_20", F.round(F.avg("close_price").over(w.rowsBetween(-19, 0)), sd))
            .withColumn("volatility_pct_20", F.round(F.stddev_samp("return_pct").over(w.rowsBetween(-19, 0)), digits)))


def gold_candles(silver: DataFrame, as_of=None, tz: str = MARKET_TZ,
                 lookback_days: int | None = GOLD_LOOKBACK_DAYS, bucket: str = "1 minute", digits: int = 4, sma_digits: int | None = None) -> DataFrame:
    """The gold candle table (17 columns)."""
    at = as_of_col(as_of)
    ticks = lookback_filter(silver, at, tz, lookback_days)
    c = ohlcv(ticks, bucket)
    c = with_moving_metrics(with_returns(with_lags(c), digits), digits, sma_digits)
    return c.withColumn("refreshed_at", at).select(*CANDLE_COLUMNS)


def intraday_running_state(ticks: DataFrame, chunk: str = "1 second") -> DataFrame:
    """Per tick, the day's open, running high/low, running tick count,
    running max and running sum of the volume, reset at every trading date.

    A plain running window would put a whole (ticker, day) in one task. Here
    the day is cut into time chunks: chunk summaries are combined with a
    prefix window over the (small) chunk table, and the running part is a
    window inside each chunk only. A hot instrument-day is spread over as many
    tasks as it has chunks.
    """
    t = ticks.select("ticker", "trading_date", "quote_ts", "price", "volume",
                     bucket_start("quote_ts", chunk).alias("__chunk"))
    keys = [*DAY, "__chunk"]
    chunks = t.groupBy(*keys).agg(
        F.min_by("price", "quote_ts").alias("c_first"),
        F.max("price").alias("c_high"),
        F.min("price").alias("c_low"),
        F.count(F.lit(1)).alias("c_n"),
        F.max("volume").alias("c_vol"),
        F.sum("volume").alias("c_sum"))
    wd = Window.partitionBy(*DAY).orderBy("__chunk")
    before = wd.rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(
        *keys,
        F.first("c_first").over(wd.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("day_open"),
        F.max("c_high").over(before).alias("high_before"),
        F.min("c_low").over(before).alias("low_before"),
        F.coalesce(F.sum("c_n").over(before), F.lit(0)).alias("n_before"),
        F.max("c_vol").over(before).alias("vol_before"),
        F.sum("c_sum").over(before).alias("sum_before"))
    wc = Window.partitionBy(*keys).orderBy("quote_ts")
    run = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = t.join(carry, keys, "inner")
    return j.select(
        "ticker", "trading_date", "quote_ts", "price", "day_open",
        F.greatest(F.col("high_before"), F.max("price").over(run)).alias("day_high"),
        F.least(F.col("low_before"), F.min("price").over(run)).alias("day_low"),
        (F.col("n_before") + F.row_number().over(wc)).alias("ticks_so_far"),
        F.greatest(F.col("vol_before"), F.max("volume").over(run)).alias("volume_so_far"),
        # NULL only while no reading of the day has a volume.
        F.coalesce(F.col("sum_before") + F.sum("volume").over(run), "sum_before", F.sum("volume").over(run))
        .alias("volume_sum_so_far"),
    )
