"""Price anomalies in sliding windows.

A price is compared with the median of its instrument's window, in units of the
window's median absolute deviation (scaled to a standard deviation). Both medians
are exact and mergeable: ticks are counted per (instrument, pane, price), a window
adds up the panes it covers, and a median is read off the running count of its
prices. A window therefore holds its distinct prices, not its ticks, and a hot
instrument's ticks are counted where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.timeutil import bucket_start, interval_micros

# Fixed value: a normal distribution's standard deviation per MAD.
MAD_SCALE = 1.4826
KEY = ["ticker", "window_end"]


def _median(histogram: DataFrame, value: str, out: str) -> DataFrame:
    """The median of ``value`` (counted ``n`` times) per window, the mean of the
    middle two for an even count."""
    rise = Window.partitionBy(*KEY).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = histogram.groupBy(*KEY, value).agg(F.sum("n").alias("n"))
    h = h.withColumns({"upto": F.sum("n").over(rise), "total": F.sum("n").over(Window.partitionBy(*KEY))})
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    at = lambda place: F.min(F.when(F.col("upto") >= place, F.col(value)))
    return h.groupBy(*KEY).agg(((at(low) + at(high)) / 2).alias(out), F.max("total").alias("ticks"))


def price_anomalies(ticks: DataFrame, size: str = "30 minutes", slide: str = "5 minutes", threshold: float = 6.0,
                    min_ticks: int = 10) -> DataFrame:
    """Ticks of a window's newest pane that lie over ``threshold`` scaled MADs from
    the window's median: ticker, window_end, price, median_price, mad, score,
    n_ticks (how many ticks of the pane have the price). Every tick is in the newest
    pane of one window, so it is judged once, with the ``size`` that ends there.
    Windows with fewer than ``min_ticks`` ticks, or whose prices do not vary by the
    median, judge nothing. Null prices are not looked at.
    """
    width, step = interval_micros(size), interval_micros(slide)
    if width % step:
        raise ValueError("the window's size must be a multiple of its slide")
    panes = ticks.filter("price IS NOT NULL").groupBy(
        "ticker", bucket_start("quote_ts", slide).alias("pane"), "price").agg(F.count(F.lit(1)).alias("n"))
    shift = F.explode(F.sequence(F.lit(1), F.lit(width // step)))
    spread = panes.select("ticker", "pane", "price", "n", shift.alias("k")).select(
        "ticker", F.timestamp_add("MICROSECOND", F.col("k") * F.lit(step), F.col("pane")).alias("window_end"), "price", "n",
        (F.col("k") == 1).alias("newest"))
    # Only windows that some pane ends in judge anything.
    ends = panes.select("ticker", F.timestamp_add("MICROSECOND", F.lit(step), F.col("pane")).alias("window_end")).distinct()
    held = spread.join(ends, KEY, "left_semi")
    middle = _median(held, "price", "median_price").filter(F.col("ticks") >= min_ticks)
    off = held.join(middle.drop("ticks"), KEY).withColumn("off", F.abs(F.col("price") - F.col("median_price")))
    spread_of = _median(off, "off", "mad").drop("ticks").filter("mad > 0")
    score: Column = F.col("off") / (F.lit(MAD_SCALE) * F.col("mad"))
    return off.filter("newest").join(spread_of, KEY).withColumn("score", F.round(score, 4)).filter(
        score > threshold).select("ticker", "window_end", "price", "median_price", "mad", "score",
                                  F.col("n").alias("n_ticks"))


def anomaly_alerts(anomalies: DataFrame, run_id: str, detected_at: str, dag_id: str = "price_anomalies") -> DataFrame:
    """Anomalies as alert records (severity warning), ready for ``append_json`` or,
    through :func:`~candlewick.sources.kafka.encode_events`, for an alert topic."""
    return anomalies.select(
        F.lit("warning").alias("severity"), F.lit(detected_at).alias("detected_at"), F.lit(dag_id).alias("dag_id"),
        F.col("ticker").alias("task_id"), F.lit(run_id).alias("run_id"), F.lit(1).alias("try_number"),
        F.concat_ws(" ", F.lit("price"), F.col("price").cast("string"), F.lit("score"), F.col("score").cast("string"),
                    F.lit("until"), F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")).alias("exception"),
        F.lit(None).cast("string").alias("log_url"))
