"""Serving queries: live overlay, status chips, series slicing and ordered
views (A09-A12, P25-P29, J06, L01-L07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import as_of_col
from candlewick.functions.quotes import candle_direction, clamp_pct, direction, staleness_class
from candlewick.functions.timeutil import epoch_seconds


def live_latest(bronze: DataFrame, cols: Sequence[str] = ("price", "quote_ts", "source"),
                since_date=None) -> DataFrame:
    """Per ticker, the latest non-NULL value of each column by ingestion order.

    Each column is resolved on its own (a NULL in the newest reading falls
    back to the newest non-NULL one). Ties on ingestion_ts go to the higher
    Kafka offset. ``since_date`` prunes bronze partitions.
    """
    b = bronze
    if since_date is not None:
        b = b.filter(F.col("ingestion_date") >= since_date)
    order = F.struct("ingestion_ts", "kafka_offset")
    return b.groupBy("ticker").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols],
        F.max("ingestion_ts").alias("ingestion_ts"))


def live_board(snapshot: DataFrame, live: DataFrame) -> DataFrame:
    """Snapshot with the live bronze price laid over the gold price.

    Change is recomputed against previous_close (NULL when it is 0 or NULL)
    and the price origin is tagged ``bronze`` or ``gold``.
    """
    lv = live.select("ticker", F.col("price").alias("live_price"))
    j = snapshot.join(lv, "ticker", "left")
    price = F.coalesce(F.col("live_price"), F.col("last_price"))
    base = F.col("previous_close")
    has_base = base.isNotNull() & (base != 0)
    pct = F.when(has_base, (price / base - 1) * 100)
    return j.select(
        "ticker", "source",
        price.alias("price"),
        F.when(F.col("live_price").isNotNull(), "bronze").otherwise("gold").alias("price_origin"),
        pct.alias("change_pct_live"),
        F.when(has_base, price - base).alias("change_abs_live"),
        direction(pct).alias("direction"),
        clamp_pct("day_range_position_pct").alias("range_marker_pct"),
    )


def staleness(snapshot: DataFrame, age_col: str = "seconds_since_last_tick") -> DataFrame:
    return snapshot.select("ticker", F.col(age_col).alias("age_seconds"),
                           staleness_class(age_col).alias("staleness"))


def source_mode(df: DataFrame, by: Sequence[str] = (), col: str = "source") -> DataFrame:
    """Most frequent provenance; ties resolve to the smallest value."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.mode(col, deterministic=True).alias(f"{col}_mode"))


def provenance(live: DataFrame, snapshot: DataFrame, col: str = "source") -> DataFrame:
    """One row: the most frequent provenance of the live set, or of the
    snapshot while nothing is live (ties resolve to the smallest value)."""
    now = live.select(F.mode(col, deterministic=True)).scalar()
    stored = snapshot.select(F.mode(col, deterministic=True)).scalar()
    return live.sparkSession.range(1).select(F.coalesce(now, stored).alias(f"{col}_mode"))


def stream_age(live: DataFrame, snapshot: DataFrame, as_of=None) -> DataFrame:
    """Seconds since the newest ingestion: bronze first, else the snapshot.
    Both maxima are scalar subqueries (partial aggregates, one row each)."""
    at = as_of_col(as_of)
    b = live.select(F.max("ingestion_ts")).scalar()
    s = snapshot.select(F.max("last_ingestion_ts")).scalar()
    last = F.coalesce(b, s)
    return live.sparkSession.range(1).select(last.alias("last_ingestion_ts"),
                                             (epoch_seconds(at) - epoch_seconds(last)).alias("age_seconds"))


def distinct_tickers(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct().orderBy("ticker")


def trailing_horizon(candles: DataFrame, hours: int | None) -> DataFrame:
    """Candles within ``hours`` of each ticker's own newest candle (None = all).

    The per-ticker maximum is an aggregate joined back (one small row per
    ticker) rather than a window over each ticker's whole history.
    """
    if hours is None:
        return candles
    newest = candles.groupBy("ticker").agg(F.max("window_start").alias("__newest"))
    cut = F.col("__newest") - F.make_dt_interval(hours=F.lit(hours))
    # The oldest cut of all tickers bounds the rows that enter the join (and,
    # by date, the partitions that are read at all).
    first = newest.select(F.min(cut).alias("c")).scalar()
    recent = candles.filter(F.col("window_start") >= first)
    if "trading_date" in candles.columns:
        recent = recent.filter(F.col("trading_date") >= F.date_sub(first.cast("date"), 1))
    return recent.join(newest, "ticker").filter(F.col("window_start") >= cut).drop("__newest")


def with_candle_direction(candles: DataFrame) -> DataFrame:
    return candles.withColumn("direction", candle_direction("open_price", "close_price"))


def ordered(df: DataFrame, *cols) -> DataFrame:
    """A sorted view (range-partitioned sort, no single-task funnel)."""
    return df.orderBy(*cols)


def newest(df: DataFrame, ts_col: str, n: int = 5, tie: Sequence[str] = ()) -> DataFrame:
    """The newest N rows (top-k: TakeOrderedAndProject, bounded per task).
    ``tie`` (a unique key) makes the cut exact when times are equal."""
    return df.orderBy(F.col(ts_col).desc(), *(F.col(c).desc() for c in tie)).limit(n)


def sector_ranking(sectors: DataFrame) -> DataFrame:
    """Sectors ranked by average change (best = 1). One row per sector, so the
    global window runs over a table bounded by the number of sectors."""
    from pyspark.sql import Window
    w = Window.orderBy(F.col("avg_change_pct").desc(), F.col("sector"))
    return sectors.select("sector", "avg_change_pct", "n_tickers", F.row_number().over(w).alias("position"))
