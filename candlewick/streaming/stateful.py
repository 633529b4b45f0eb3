"""Streams that keep state: running intraday state, candles, and removal of
repeated deliveries (W09, A01, T05, W01 as streams).

All three are bounded by a watermark: what it passes is emitted or forgotten.
Rows that come later than it are dropped by Spark, which counts them per batch
(``late`` in :class:`~candlewick.streaming.bronze_stream.ProgressLog`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import TimestampType

from candlewick.config import MARKET_TZ
from candlewick.functions.timeutil import to_utc_ntz, utc_instant

# Fixed value: the store that Spark's arbitrary state needs.
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_COLUMNS = ("ticker string, day int, quote_us long, price double, day_open double, day_high double, "
                 "day_low double, ticks_so_far long, volume_so_far long, volume_sum_so_far long")

# A tick as it waits in the state.
_TICK = np.dtype([("quote_us", "<i8"), ("price", "<f8"), ("volume", "<i8"), ("has_volume", "?")])
PORTION = 20_000   # ticks that leave a timer at once


def stateful_session(spark: SparkSession, partitions: int | None = None, count_rows: bool = True) -> SparkSession:
    """A session of the same context whose streams keep state in RocksDB; the
    caller's own settings stay as they are. ``partitions`` is the number of state
    partitions, fixed for the life of a checkpoint (default: the caller's number
    of shuffle partitions). Without ``count_rows`` the store does not look each key
    up once more to count it, and a batch's ``state_rows`` is not known."""
    s = spark.newSession()
    s.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    if not count_rows:
        s.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    s.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    return s


class RunningDay(StatefulProcessor):
    """Per instrument and trading day: the open, running high and low, tick count,
    largest and summed volume. Ticks wait, packed, until the watermark passes them
    and then take effect in the order of their quote time. The state is dropped
    when the watermark passes the market's midnight, so an idle instrument holds
    none."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "open double, high double, low double, ticks long, volume_max long, "
                                               "volume_sum long, ends_ms long")
        self.waiting = handle.getListState("waiting", "ends_ms long, ticks binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            ticks = np.empty(len(part), _TICK)
            for name in _TICK.names:
                ticks[name] = part[name]
            at = int(ticks["quote_us"].min())
            first = at if first is None else min(first, at)
            self.waiting.appendValue((int(part["ends_ms"].iloc[0]), ticks.tobytes()))
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        kept = list(self.waiting.get())
        day = self.day.get() if self.day.exists() else None
        ends = kept[0][0] if kept else None
        ticks = np.concatenate([np.frombuffer(k[1], _TICK) for k in kept]) if kept else np.empty(0, _TICK)
        del kept
        ticks = ticks[np.argsort(ticks["quote_us"], kind="stable")]
        n = int(np.searchsorted(ticks["quote_us"], mark * 1000))
        for at in range(0, n, PORTION):
            due = ticks[at:min(at + PORTION, n)]
            if day is None:
                day = (float(due["price"][0]), -np.inf, np.inf, 0, None, None, ends)
            frame, day = _run(key, day, due)
            yield frame
        if n:
            left = ticks[n:]
            if len(left):
                self.waiting.put([(ends, left.tobytes())])
                self.handle.registerTimer(int(left["quote_us"][0]) // 1000 + 1)
            else:
                self.waiting.clear()
        if day is not None and day[6] <= mark:
            self.day.clear()
        elif n:
            self.day.update(day)
            self.handle.registerTimer(day[6])

    def close(self) -> None:
        pass


def _run(key: tuple, day: tuple, ticks: np.ndarray) -> tuple[pd.DataFrame, tuple]:
    """Some of a day's ticks on top of its state so far."""
    opened, high, low, n, most, total, ends = day
    price, has = ticks["price"], ticks["has_volume"]
    highs, lows = np.maximum(np.maximum.accumulate(price), high), np.minimum(np.minimum.accumulate(price), low)
    mosts = np.maximum.accumulate(np.where(has, ticks["volume"], np.iinfo(np.int64).min if most is None else most))
    totals = np.cumsum(np.where(has, ticks["volume"], 0)) + (total or 0)
    if most is not None:
        mosts = np.maximum(mosts, most)
    none = ~(np.logical_or.accumulate(has) | (most is not None))   # no tick of the day has had a volume
    frame = pd.DataFrame({
        "ticker": key[0], "day": key[1], "quote_us": ticks["quote_us"], "price": price, "day_open": opened,
        "day_high": highs, "day_low": lows, "ticks_so_far": np.arange(n + 1, n + len(ticks) + 1),
        "volume_so_far": pd.arrays.IntegerArray(mosts, none), "volume_sum_so_far": pd.arrays.IntegerArray(totals, none)})
    most, total = (None, None) if none[-1] else (int(mosts[-1]), int(totals[-1]))
    return frame, (opened, float(highs[-1]), float(lows[-1]), n + len(ticks), most, total, ends)


def running_state(ticks: DataFrame, delay: str = "10 minutes", tz: str = MARKET_TZ) -> DataFrame:
    """W09 over a stream of silver ticks (one row per instrument and quote time):
    the columns and values of :func:`~candlewick.operators.candles.intraday_running_state`
    for every tick that the watermark (``delay`` behind the newest quote) has passed.

    The stream must belong to a :func:`stateful_session`. A state is one instrument's
    trading day: its ticks of one micro-batch are one task's work, held as 25 bytes
    each while they are ordered, and leave in portions; what waits is bounded by
    the delay.
    """
    midnight = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.date_add("trading_date", 1).cast("timestamp_ntz"))
    t = ticks.select(
        "ticker", F.unix_date("trading_date").alias("day"), F.unix_micros(utc_instant("quote_ts")).alias("quote_us"),
        "price", F.coalesce("volume", F.lit(0)).cast("long").alias("volume"), F.col("volume").isNotNull().alias("has_volume"),
        F.unix_millis(utc_instant(midnight)).alias("ends_ms"),
        utc_instant("quote_ts").alias("at")).withWatermark("at", delay)
    out = t.groupBy("ticker", "day").transformWithStateInPandas(
        RunningDay(), STATE_COLUMNS, "Append", "EventTime")
    return out.select("ticker", F.date_from_unix_date("day").alias("trading_date"),
                      to_utc_ntz(F.timestamp_micros("quote_us"), TimestampType()).alias("quote_ts"),
                      "price", "day_open", "day_high", "day_low", "ticks_so_far", "volume_so_far", "volume_sum_so_far")


def candles_stream(ticks: DataFrame, bucket: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """A01 over a stream of silver ticks: a candle is emitted once, when the
    watermark passes its end; ticks that come later than that are dropped."""
    t = ticks.withColumn("__at", utc_instant("quote_ts")).withWatermark("__at", delay)
    c = t.groupBy("ticker", "trading_date", F.window("__at", bucket).alias("__w")).agg(
        F.min_by("price", "quote_ts").alias("open_price"), F.max("price").alias("high_price"),
        F.min("price").alias("low_price"), F.max_by("price", "quote_ts").alias("close_price"),
        F.count(F.lit(1)).alias("n_ticks"), F.max("volume").alias("volume_cumulative"),
        F.round(F.avg("feed_delay_seconds"), 1).alias("avg_feed_delay_seconds"), F.max("source").alias("source"))
    start = F.convert_timezone(None, F.lit("UTC"), F.col("__w.start"))
    return c.select("ticker", "trading_date", start.alias("window_start"), "open_price", "high_price", "low_price",
                    "close_price", "n_ticks", "volume_cumulative", "avg_feed_delay_seconds", "source")


def deliver_once(bronze: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """A bronze stream without events that were delivered before, as long as the
    copy comes within ``delay`` of the first by ingestion time; the state of older
    ones is dropped. Copies of an event are equal, so it does not matter which of
    them goes on; different readings of one quote are different events, and the
    first-wins merge into silver chooses among them. An event without an id is
    told by its partition and offset. The state has a row per event of that time: in a
    :func:`stateful_session` it is on disk, else in the executors' heap, twice."""
    place = F.concat_ws(":", F.lit("at"), "kafka_partition", "kafka_offset")
    named = bronze.withColumns({f"__k{i}": F.coalesce(F.col(k).cast("string"), place) for i, k in enumerate(keys)})
    named = named.withColumn("__at", utc_instant("ingestion_ts")).withWatermark("__at", delay)
    return named.dropDuplicatesWithinWatermark([f"__k{i}" for i in range(len(keys))]).drop(
        "__at", *(f"__k{i}" for i in range(len(keys))))


def start_append(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ("trading_date",),
                 trigger: str | None = "15 seconds", available_now: bool = False,
                 query_name: str | None = None) -> StreamingQuery:
    """Append a stream's rows to a Parquet table, exactly once across restarts."""
    w = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by))
    w = w.queryName(query_name) if query_name else w
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start(path)
