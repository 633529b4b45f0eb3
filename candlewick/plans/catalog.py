"""Registered queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
parquet tables (quotes are derived from ``events`` by
:mod:`candlewick.sources.events_feed`, the dimension from ``customer`` and
``nation``). Fixed evaluation parameters keep results deterministic:
``as_of`` is pinned and every timestamp is UTC TIMESTAMP_NTZ.

Two ticker mappings are used: ``type`` (5 instruments, dense intraday
series: candle and window queries) and ``user`` (one instrument per
customer: snapshot, sectors, joins to the dimension).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import scratch_path
from candlewick.sources.tables import materialize
from candlewick.functions import display
from candlewick.functions.quotes import expected_source
from candlewick.functions.timeutil import market_date, market_is_open, market_local
from candlewick.operators import quality as q
from candlewick.operators import serving
from candlewick.operators.candles import gold_candles, intraday_running_state, ohlcv, with_lags, with_moving_metrics, \
    with_returns
from candlewick.operators.common import lookback_filter
from candlewick.operators.sectors import sector_performance
from candlewick.operators.silver import incremental_slice, merge_frames, silver_quotes, valid_quotes
from candlewick.operators.snapshot import day_aggregate, day_range_position, latest_candle, latest_tick, \
    ticker_snapshot
from candlewick.plans.batch_run import run_summary
from candlewick.sources.api import missing_tickers, normalize_api
from candlewick.sources.events_feed import api_payloads, bronze_rows, dim_from_customers, kafka_records
from candlewick.sources.kafka import encode_events, to_bronze

# Fixed evaluation parameters of the registered queries (shared with the SQL oracle).
AS_OF = "2024-01-31 00:00:00"
TZ = "America/Sao_Paulo"
BUCKET = "1 hour"
LOOKBACK_DAYS = 30          # covers the whole month of test data
SMA_DIGITS = 6
SLICE_CUT = "2024-01-20 12:00:00"      # silver built from readings before this instant
FRESH_AS_OF = "2024-02-01 00:00:00"    # a day after the last reading: stale
FUTURE_AS_OF = "2024-01-20 00:00:00"   # quotes after this are "in the future"
LEVELS_AS_OF = "2024-01-31 00:30:00"   # per-ticker freshness spans pass/warn/error
HORIZON_HOURS = 6
STREAM_BATCH = 1 << 30                 # bytes of input per micro-batch


def _at(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def bronze(spark: SparkSession, d: str, by: str = "type") -> DataFrame:
    """The bronze table as stored (typed); see :func:`q_bronze_decode` for the wire path."""
    return bronze_rows(events(spark, d), by, AS_OF, TZ)


def silver(spark: SparkSession, d: str, by: str = "type") -> DataFrame:
    return silver_quotes(bronze(spark, d, by), TZ)


def ticks(spark: SparkSession, d: str, by: str = "type") -> DataFrame:
    return lookback_filter(silver(spark, d, by), _at(AS_OF), TZ, LOOKBACK_DAYS)


def candles(spark: SparkSession, d: str, by: str = "type") -> DataFrame:
    return gold_candles(silver(spark, d, by), AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS)


def dim(spark: SparkSession, d: str) -> DataFrame:
    return dim_from_customers(table(spark, d, "customer"), table(spark, d, "nation"))


def silver_table(spark: SparkSession, d: str, by: str = "type") -> DataFrame:
    """Silver written once (as the batch build stores it) for queries that read it several times."""
    return materialize(silver(spark, d, by), f"silver_{by}", ["trading_date"])


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    s = silver_table(spark, d, "user")
    c = gold_candles(s, AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS)
    return ticker_snapshot(s, c, dim(spark, d), AS_OF, TZ, LOOKBACK_DAYS)


def sectors(spark: SparkSession, d: str) -> DataFrame:
    return sector_performance(snapshot(spark, d))


# --- bronze / sources -------------------------------------------------------

def q_bronze_decode(spark, d):
    """Kafka records (JSON text) decoded into bronze rows."""
    return to_bronze(kafka_records(events(spark, d), "type"), as_of=AS_OF, tz=TZ)


def q_api_normalize(spark, d):
    p = api_payloads(events(spark, d), "type")
    return normalize_api(p, cycle_col=None, event_id=F.concat(F.lit("req-"), F.col("request_id").cast("string")),
                         ingestion_ts=F.col("ingestion_ts"))


def q_event_encode(spark, d):
    s = silver(spark, d, "type").select("event_id", "ticker", "price", "volume", "source")
    return encode_events(s)


def q_coverage_missing(spark, d):
    """Dimension tickers with no quote on the as-of trading day."""
    day = silver(spark, d, "user").filter(F.col("trading_date") == market_date(_at(AS_OF), TZ))
    return missing_tickers(dim(spark, d).select("ticker", "company_name"), day)


# --- silver -------------------------------------------------------------------

def q_silver_filter(spark, d):
    return valid_quotes(bronze(spark, d, "type"))


def q_silver_change_pct(spark, d):
    return silver(spark, d, "type").select("ticker", "quote_ts", "price", "previous_close", "change_pct")


def q_silver_feed_delay(spark, d):
    return silver(spark, d, "type").select("ticker", "quote_ts", "ingestion_ts", "feed_delay_seconds")


def q_silver_dedup(spark, d):
    return silver(spark, d, "type")


def _target_and_slice(spark, d):
    b = bronze(spark, d, "type")
    target = silver_quotes(b.filter(F.col("ingestion_ts") < _at(SLICE_CUT)), TZ)
    return b, target, incremental_slice(b, target, tz=TZ)


def q_silver_incremental_slice(spark, d):
    return _target_and_slice(spark, d)[2]


def q_silver_merge(spark, d):
    _, target, sl = _target_and_slice(spark, d)
    return merge_frames(target, silver_quotes(sl, TZ))


def q_silver_schema_evolution(spark, d):
    """A source that carries a new column (market_cap) merged into an older
    silver: the column is appended, NULL for rows that predate it."""
    _, target, sl = _target_and_slice(spark, d)
    return merge_frames(target, silver_quotes(sl, TZ, keep=["market_cap"]))


# --- candles ------------------------------------------------------------------

def _ohlcv(spark, d, by="type"):
    return ohlcv(ticks(spark, d, by), BUCKET)


def q_candles_ohlcv(spark, d):
    return _ohlcv(spark, d)


def q_candles_lag_volume_delta(spark, d):
    return with_lags(_ohlcv(spark, d)).select(
        "ticker", "trading_date", "window_start", "close_price", "volume_cumulative", "prev_close_price",
        "prev_volume_cumulative", "volume_delta")


def q_candles_return(spark, d):
    return with_returns(with_lags(_ohlcv(spark, d))).select(
        "ticker", "trading_date", "window_start", "close_price", "prev_close_price", "return_pct")


def q_candles_sma(spark, d):
    c = with_moving_metrics(with_returns(with_lags(_ohlcv(spark, d))), 4, SMA_DIGITS)
    return c.select("ticker", "trading_date", "window_start", "close_price", "sma_9", "sma_20")


def q_candles_volatility(spark, d):
    c = with_moving_metrics(with_returns(with_lags(_ohlcv(spark, d))), 4, SMA_DIGITS)
    return c.select("ticker", "trading_date", "window_start", "return_pct", "volatility_pct_20")


def q_candles_full(spark, d):
    return candles(spark, d, "type")


def q_intraday_running_state(spark, d):
    return intraday_running_state(silver_table(spark, d, "type"))


# --- snapshot / sectors ---------------------------------------------------------

def q_latest_tick(spark, d):
    return latest_tick(ticks(spark, d, "user"))


def q_latest_candle(spark, d):
    return latest_candle(candles(spark, d, "user"))


def q_day_aggregate(spark, d):
    return day_aggregate(silver(spark, d, "type"))


def q_snapshot_full(spark, d):
    return snapshot(spark, d)


def q_day_range_position(spark, d):
    s = silver(spark, d, "type")
    return s.select("ticker", "quote_ts", "price", "day_low", "day_high",
                    day_range_position("price", "day_low", "day_high").alias("day_range_position_pct"))


def q_sector_performance(spark, d):
    return sectors(spark, d)


def q_sector_ranking(spark, d):
    return serving.sector_ranking(sectors(spark, d))


# --- quality ------------------------------------------------------------------------

def q_dq_not_null(spark, d):
    return q.not_null(silver(spark, d, "type"), "change_pct")


def q_dq_unique(spark, d):
    return q.unique(bronze(spark, d, "type"), "quote_ts")


def q_dq_accepted_values(spark, d):
    return q.accepted_values(silver(spark, d, "type"), "source", ["brapi"])


def _solvent(spark, d):
    return table(spark, d, "customer").filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("ticker"))


def q_dq_relationships(spark, d):
    return q.relationships(silver(spark, d, "user"), "ticker", _solvent(spark, d), "ticker")


def q_dq_between(spark, d):
    return q.between(silver(spark, d, "type"), "change_pct", -30.0, 30.0)


def q_dq_unique_combination(spark, d):
    return q.unique_combination(bronze(spark, d, "type"), ["ticker", "quote_ts"])


def q_dq_fresh(spark, d):
    return q.assert_fresh(bronze(spark, d, "type"), "ingestion_ts", 20, FRESH_AS_OF)


def q_dq_ohlc(spark, d):
    """The day range must contain the day open and the current price."""
    return q.assert_ohlc(silver(spark, d, "type"), "day_open", "day_high", "day_low", "price",
                         keys=("ticker", "quote_ts"))


def q_dq_no_future(spark, d):
    return q.assert_no_future(silver(spark, d, "type"), "quote_ts", FUTURE_AS_OF)


def q_dq_freshness_levels(spark, d):
    return q.freshness(bronze(spark, d, "type"), "ingestion_ts", 5, 20, LEVELS_AS_OF, by=["ticker"])


def q_run_summary(spark, d):
    """The batch build (tables written under the checkpoint folder) with all
    suites evaluated (gate off), summarised per layer and in total."""
    from candlewick.plans.batch_run import build
    root = scratch_path(spark, "batch")
    b = bronze(spark, d, "user")
    dm = dim(spark, d)
    _, results = build(spark, b, dm, root, AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS, gate=False,
                       dim_parent=_solvent(spark, d).join(dm, "ticker"))
    return run_summary(results)


# --- serving --------------------------------------------------------------------------

def q_market_session(spark, d):
    s = silver(spark, d, "type")
    return s.select("ticker", "quote_ts", market_local("quote_ts", TZ).alias("local_ts"),
                    market_is_open("quote_ts", TZ).alias("session_open"),
                    expected_source("quote_ts", TZ).alias("expected_source"), "source")


def _live(spark, d):
    since = F.date_sub(market_date(_at(AS_OF), TZ), 1)
    return serving.live_latest(bronze(spark, d, "user"), since_date=since)


def q_live_board(spark, d):
    return serving.live_board(snapshot(spark, d), _live(spark, d))


def q_staleness_class(spark, d):
    return serving.staleness(snapshot(spark, d))


def q_source_mode(spark, d):
    return serving.source_mode(bronze(spark, d, "user"), by=["ticker", "ingestion_date"])


def q_trailing_horizon(spark, d):
    return serving.trailing_horizon(candles(spark, d, "type"), HORIZON_HOURS)


def q_board_display(spark, d):
    s = snapshot(spark, d)
    return s.select(
        "ticker",
        display.brl("last_price").alias("price_text"),
        display.signed_pct("change_pct").alias("change_text"),
        display.num_ptbr("change_abs").alias("change_abs_text"),
        display.num_ptbr("day_low").alias("low_text"),
        display.num_ptbr("day_high").alias("high_text"),
        display.compact("volume_cumulative").alias("volume_text"),
        display.num_ptbr("volatility_pct_20").alias("vol20_text"),
        display.human_age("feed_delay_seconds").alias("delay_text"),
        display.human_age("seconds_since_last_tick").alias("age_text"),
    )


# --- storage round trips ------------------------------------------------------------------

def q_dim_seed(spark, d):
    """Write the dimension as a header CSV seed, load it back with declared types."""
    from candlewick.sources.tables import load_dim
    path = scratch_path(spark, "dim_seed")
    dim(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return load_dim(spark, path)


def q_compaction_roundtrip(spark, d):
    """Silver written as many small files per day, compacted, read back unchanged."""
    from candlewick.sources.tables import compact
    path = scratch_path(spark, "compaction")
    silver(spark, d, "type").write.partitionBy("trading_date").parquet(path)
    compact(spark, path, "trading_date")
    return spark.read.parquet(path)


def q_stream_bronze_counts(spark, d):
    """Kafka-shaped files streamed into a partitioned bronze table, counted back."""
    from candlewick.functions.timeutil import utc_instant
    from candlewick.sources.kafka import quote_stream
    from candlewick.streaming.bronze_stream import await_or_raise, start_bronze
    src = scratch_path(spark, "stream_src")
    out = scratch_path(spark, "stream_bronze")
    chk = scratch_path(spark, "stream_chk")
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    rec.write.parquet(src)
    qy = start_bronze(quote_stream(spark, "parquet", src, maxBytesPerTrigger=STREAM_BATCH), out, chk, available_now=True, tz=TZ)
    await_or_raise(qy)
    return (spark.read.parquet(out).groupBy("ingestion_date", "ticker")
            .agg(F.count(F.lit(1)).alias("n_rows")))


# --- operations: streaming upsert, layer gate, alerts, logs, catalog -------------------

def q_stream_silver_upsert(spark, d):
    """Kafka-shaped files -> streaming bronze -> foreachBatch first-wins merge into silver."""
    from candlewick.functions.timeutil import utc_instant
    from candlewick.sources.kafka import quote_stream
    from candlewick.streaming.bronze_stream import await_or_raise, start_silver_upsert
    src, out, chk = (scratch_path(spark, n) for n in ("upsert_src", "upsert_silver", "upsert_chk"))
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    rec.write.parquet(src)
    stream = to_bronze(quote_stream(spark, "parquet", src, maxBytesPerTrigger=STREAM_BATCH), as_of=AS_OF, tz=TZ)
    await_or_raise(start_silver_upsert(stream, out, chk, tz=TZ, available_now=True))
    return spark.read.parquet(out).drop("processing_ts")


def q_stream_progress(spark, d):
    """Streaming ingest of the readings; one logged row per batch, whatever Spark
    retains, summed up to every reading once."""
    from candlewick.functions.timeutil import utc_instant
    from candlewick.sources.kafka import quote_stream
    from candlewick.streaming.bronze_stream import ProgressLog, await_or_raise, progress_frame, start_bronze
    src, out, chk, log = (scratch_path(spark, n) for n in ("progress_src", "progress_bronze", "progress_chk", "progress"))
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    rec.write.parquet(src)
    listener = ProgressLog(log)
    spark.streams.addListener(listener)
    try:
        qy = start_bronze(quote_stream(spark, "parquet", src, maxFilesPerTrigger=1), out, chk, available_now=True, tz=TZ)
        await_or_raise(qy)
        listener.wait(qy)
    finally:
        spark.streams.removeListener(listener)
    return progress_frame(spark, log).agg(
        F.sum("rows").alias("total_rows"),
        (F.count("batch_id") == F.count_distinct("query", "batch_id")).alias("batches_counted_once"))


def _gated(spark, d):
    from candlewick.plans.batch_run import build
    dm = dim(spark, d)
    return build(spark, bronze(spark, d, "user"), dm, scratch_path(spark, "gated"), AS_OF, TZ, LOOKBACK_DAYS,
                 BUCKET, 4, SMA_DIGITS, gate=True, dim_parent=_solvent(spark, d).join(dm, "ticker"))


def q_gated_build(spark, d):
    """Layer gate: the silver suite fails on this data, so gold never starts."""
    return _gated(spark, d)[1]


def q_silver_incremental_build(spark, d):
    """Two incremental batch builds (readings up to the cut, then all) leave
    silver equal to a full refresh."""
    from candlewick.plans.batch_run import build
    root = scratch_path(spark, "incremental")
    b = bronze(spark, d, "type")
    for part in (b.filter(F.col("ingestion_ts") < _at(SLICE_CUT)), b):
        tables, _ = build(spark, part, dim(spark, d), root, AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS,
                          gate=True, incremental=True)
    return tables["silver"]


def q_alerts(spark, d):
    from candlewick.plans.batch_run import alerts_from
    return alerts_from(_gated(spark, d)[1], run_id="run-" + AS_OF[:10], detected_at=AS_OF.replace(" ", "T") + "+00:00")


def q_ops_log_tail(spark, d):
    """All readings appended to a JSON-lines log in two batches, plus a corrupt
    line; the five newest are read back (ties by the unique offset)."""
    from candlewick.sources.oplog import append_json, tail_json
    log = scratch_path(spark, "oplog")
    cols = ["ticker", "kafka_offset", "price", "ingestion_ts"]
    b = bronze(spark, d, "type").select(*cols)
    for half in (0, 1):
        append_json(b.filter(F.col("kafka_offset") % 2 == half), log)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(log)
    return tail_json(spark, log, b.schema, "ingestion_ts", 5, tie=["kafka_offset"])


def q_stream_age(spark, d):
    return serving.stream_age(_live(spark, d), snapshot(spark, d), AS_OF)


def q_distinct_tickers(spark, d):
    return serving.distinct_tickers(candles(spark, d, "type"))


def q_candle_direction(spark, d):
    return serving.with_candle_direction(candles(spark, d, "type")).select(
        "ticker", "window_start", "open_price", "close_price", "direction")


def q_top_movers(spark, d):
    """Ad-hoc SQL over the snapshot, capped at 50 rows (the ranking is the feature)."""
    from candlewick.sources.tables import show_query
    view = "snapshot_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    snapshot(spark, d).createOrReplaceTempView(view)
    top, _ = show_query(spark, f"SELECT ticker, change_pct FROM {view} ORDER BY change_pct DESC, ticker", 50)
    spark.catalog.dropTempView(view)   # the plan is resolved by now
    return top


def q_registered_bronze(spark, d):
    """Bronze written partitioned, registered in the catalog, read back pruned."""
    from candlewick.sources.tables import register, write_table
    path = scratch_path(spark, "bronze_table")
    write_table(bronze(spark, d, "type"), path, ["ingestion_date"])
    name = "bronze_" + path.rsplit("-", 1)[-1]
    register(spark, "lake", name, path)
    since = F.date_sub(market_date(_at(AS_OF), TZ), 1)
    return (spark.table(f"lake.{name}").select("ticker", "price", "ingestion_ts", "ingestion_date")
            .filter(F.col("ingestion_date") >= since))


# --- storage that loses nothing ------------------------------------------------------------

def _days(spark, d):
    """Silver of the type feed with a source column market_cap, and its first and last day."""
    b = bronze(spark, d, "type")
    s = materialize(silver_quotes(b, TZ, keep=["market_cap"]), "evolving")
    first, last = s.agg(F.min("trading_date"), F.max("trading_date")).first()
    return s, first, last


def q_merge_evolution_on_disk(spark, d):
    """Three merges on disk: rows without market_cap, all later rows with it, then
    some rows of the last day again without it. The column survives."""
    from candlewick.sources.tables import merge_into, stored
    s, first, last = _days(spark, d)
    path = scratch_path(spark, "evolution")
    day = F.col("trading_date")
    merge_into(spark, s.filter(day == F.lit(first)).drop("market_cap"), path)
    merge_into(spark, s.filter(day > F.lit(first)), path)
    again = s.filter((day == F.lit(last)) & (F.col("kafka_offset") % 2 == 0)).drop("market_cap")
    merge_into(spark, again.withColumn("ingestion_ts", F.col("ingestion_ts") + F.expr("INTERVAL 1 DAY")), path)
    return stored(spark, path).drop("processing_ts")


def q_full_refresh_replaces(spark, d):
    """A full refresh after which no day of the older table is left."""
    from candlewick.sources.tables import write_table
    s, first, _ = _days(spark, d)
    path = scratch_path(spark, "refresh")
    write_table(s, path, ["trading_date"])
    write_table(s.filter(F.col("trading_date") > F.lit(first)), path, ["trading_date"])
    return spark.read.parquet(path).groupBy("trading_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_merge_into_table(spark, d):
    """The target table and a high-water slice merged by day and quote hour."""
    from candlewick.sources.tables import merge_silver, stored
    _, target, sl = _target_and_slice(spark, d)
    path = scratch_path(spark, "merged")
    merge_silver(spark, target, path, by_hour=True)
    merge_silver(spark, silver_quotes(sl, TZ), path, by_hour=True)
    return stored(spark, path)


def q_compact_streamed(spark, d):
    """Closed days of a streamed table compacted aside; the stream goes on."""
    from candlewick.functions.timeutil import utc_instant
    from candlewick.sources.kafka import quote_stream
    from candlewick.sources.tables import compact_closed, read_compacted
    from candlewick.streaming.bronze_stream import await_or_raise, start_bronze
    src, out, chk, into = (scratch_path(spark, n) for n in ("closed_src", "closed_bronze", "closed_chk", "closed_into"))
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    before = _at(SLICE_CUT).cast("date")
    for part in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        rec.filter(part).write.mode("append").parquet(src)
        await_or_raise(start_bronze(quote_stream(spark, "parquet", src, maxBytesPerTrigger=STREAM_BATCH), out, chk,
                                    available_now=True, tz=TZ))
        compact_closed(spark, out, into, "ingestion_date", before)
    return read_compacted(spark, out, into, "ingestion_date", before).drop("processing_ts")


# --- values the feed does not bring by itself -----------------------------------------------

def q_candles_source_mixed(spark, d):
    """Candles over ticks whose provenance is also unknown or outside the accepted two."""
    odd = (F.when(F.col("kafka_offset") % 7 < 3, F.lit(None)).when(F.col("kafka_offset") % 11 == 0, F.lit("zzz"))
           .when(F.col("kafka_offset") % 5 == 0, F.lit("other")).otherwise(F.col("source")))
    t = ticks(spark, d, "type").withColumn("source", F.when(F.col("ticker") == "click", F.lit(None)).otherwise(odd))
    return ohlcv(t, "1 minute").select("ticker", "window_start", "n_ticks", "source")


def _planted(spark, d):
    """Readings with bad volumes and times, by their number."""
    k = F.col("event_id") % 6
    return events(spark, d).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("wall"), k.cast("int").alias("k"),
        F.when(k == 0, "NaN").when(k == 1, "1e30").when(k == 2, "9007199254740993").when(k == 3, "12.0").when(k == 4, "x")
        .otherwise(F.lit(None)).alias("volume_text"),
        F.when(k == 0, "0001-01-01T00:00:00Z").when(k == 1, F.col("wall")).when(k == 2, F.concat("wall", F.lit("+03:00")))
        .when(k == 3, F.concat(F.translate("wall", " ", "T"), F.lit("Z"))).when(k == 4, "soon").otherwise(F.lit(None))
        .alias("time_text"))


def q_planted_bad_values(spark, d):
    """Bad volumes normalised and bad times parsed without an error or a session zone."""
    from candlewick.functions.quotes import feed_delay_seconds
    from candlewick.functions.timeutil import parse_utc
    p = _planted(spark, d)
    payload = F.to_json(F.struct(F.array(F.struct(
        F.col("event_id").cast("string").alias("symbol"), F.col("volume_text").alias("regularMarketVolume"))).alias("results")))
    n = normalize_api(p.select("event_id", "time_text", "wall", payload.alias("payload")), cycle_col=None,
                      event_id=F.col("event_id"), ingestion_ts=F.struct("time_text", "wall"))
    quote = parse_utc(F.col("ingestion_ts.time_text"))
    return n.select("event_id", "volume", quote.alias("quote_ts"),
                    feed_delay_seconds(parse_utc(F.col("ingestion_ts.wall")), quote).alias("feed_delay_seconds"))


# --- run record, alerts, gold of an incremental build -----------------------------------------

def _logged(spark, d):
    """Two builds of which the first fails its silver suite; both leave a record."""
    from candlewick.plans.batch_run import build
    dm, root = dim(spark, d), scratch_path(spark, "logged")
    for name, gate in (("gated", True), ("open", False)):
        build(spark, bronze(spark, d, "user"), dm, root, AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS, gate=gate,
              dim_parent=_solvent(spark, d).join(dm, "ticker"), run_id=name, logical_date=AS_OF[:10])
    return root


def q_run_record(spark, d):
    from candlewick.schemas import RUN_SCHEMA
    from candlewick.sources.oplog import tail_json
    log = tail_json(spark, _logged(spark, d) + "/logs/runs", RUN_SCHEMA, "finished_at", 10, tie=["run_id"])
    return log.select("run_id", "logical_date", "models", "seeds", "tests_pass", "tests_fail", "status",
                      F.col("layers")["silver"]["tests_pass"].alias("silver_pass"))


def q_alerts_log(spark, d):
    from candlewick.schemas import ALERT_SCHEMA
    log = spark.read.schema(ALERT_SCHEMA).json(_logged(spark, d) + "/logs/alerts")
    return log.groupBy("run_id", "task_id").agg(F.count(F.lit(1)).alias("n_alerts"))


RESULTS_NODES = 5000   # nodes in one results file, about


def _results_files(spark, d):
    """One folder of nested run-results files per market segment; a file holds a
    bounded number of nodes, one per customer of a nation."""
    path = scratch_path(spark, "results")
    c = table(spark, d, "customer")
    groups = c.groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).agg(
        F.ceil(F.count(F.lit(1)) / RESULTS_NODES).alias("buckets"))
    node = F.struct(F.concat(F.lit("test.c"), F.col("c_custkey").cast("string")).alias("unique_id"),
                    F.when(F.col("c_acctbal") < 0, "fail").otherwise("pass").alias("status"),
                    (F.col("c_custkey") / 4).alias("execution_time"))
    nations = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("elapsed_time"))
    own = F.col("c_mktsegment").eqNullSafe(F.col("segment")) & (F.col("c_nationkey") == F.col("nation"))
    files = c.join(groups, own).withColumn("bucket", F.pmod(F.xxhash64("c_custkey"), "buckets")).groupBy(
        "c_mktsegment", "c_nationkey", "bucket").agg(F.collect_list(node).alias("results")).join(nations, "c_nationkey")
    (files.select("results", "elapsed_time", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
                  F.col("bucket").alias("file")).write.partitionBy("segment", "nation", "file").json(path))
    return path


def q_run_results_read(spark, d):
    """Nested run-results files read as one row per node."""
    from candlewick.sources.oplog import read_run_results
    return read_run_results(spark, _results_files(spark, d), "seed")


def q_run_artifacts(spark, d):
    """The summary of a run whose layers are market segments, of which one left no
    results: counts, summed elapsed times, and what did not run."""
    from candlewick.plans.batch_run import artifact_summary
    path = _results_files(spark, d)
    layers = {x: f"{path}/segment={x}" for x in ("BUILDING", "MACHINERY", "HOUSEHOLD")}
    return artifact_summary(spark, {**layers, "absent": f"{path}/segment=none"})


def q_incremental_gold(spark, d):
    """Candles after two incremental builds whose dimension holds every instrument."""
    from candlewick.plans.batch_run import build
    root, b = scratch_path(spark, "incremental_gold"), bronze(spark, d, "type")
    dm = b.select("ticker").distinct().select(
        "ticker", F.col("ticker").alias("company_name"), F.lit("all").alias("sector"), F.lit(None).cast("string").alias("b3_index"))
    for part in (b.filter(F.col("ingestion_ts") < _at(SLICE_CUT)), b):
        tables, _ = build(spark, part, dm, root, AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS, gate=False,
                          incremental=True)
    return tables["candles"]


# --- serving rows not reached otherwise -----------------------------------------------------

def q_provenance(spark, d):
    return serving.provenance(_live(spark, d), snapshot(spark, d))


def q_snapshot_by_ticker(spark, d):
    return serving.ordered(snapshot(spark, d).select("ticker", "last_price"), "ticker")


def q_sectors_ascending(spark, d):
    return serving.ordered(sectors(spark, d).select("sector", "avg_change_pct"), F.col("avg_change_pct").asc(), "sector")


def q_candles_minute(spark, d):
    """The default bucket."""
    return ohlcv(ticks(spark, d, "type")).select("ticker", "window_start", "open_price", "high_price", "low_price",
                                                 "close_price", "n_ticks", "volume_cumulative", "source")


def q_bootstrap_empty(spark, d):
    """An empty table, created twice, takes rows and keeps its schema."""
    from candlewick.sources.kafka import empty_bronze
    from candlewick.sources.tables import bootstrap_table, read_table
    path = scratch_path(spark, "bootstrap")
    empty = empty_bronze(spark, TZ)
    for _ in range(2):
        bootstrap_table(empty, path, ["ingestion_date"])
    none = read_table(spark, path, empty.schema)
    to_bronze(kafka_records(events(spark, d), "type"), as_of=AS_OF, tz=TZ).write.mode("append").partitionBy(
        "ingestion_date").parquet(path)
    bootstrap_table(empty, path, ["ingestion_date"])
    full = read_table(spark, path, empty.schema)
    return full.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(none.isEmpty()).alias("was_empty"))


# --- gold that follows its merges ------------------------------------------------------------

def _corrections(s):
    """Silver in three deliveries: most rows, and twice some that come late."""
    late = F.pmod(F.xxhash64("event_id"), F.lit(50))
    return [s.filter(late > 1), s.filter(late == 0), s.filter(late == 1)]


def q_incremental_corrections(spark, d):
    """Candles after two rounds of late corrections all over the month."""
    from candlewick.operators.incremental import refresh_candles, touched_buckets
    from candlewick.sources.tables import merge_silver, stored
    root = scratch_path(spark, "corrections")
    for part in _corrections(silver_table(spark, d)):
        merge_silver(spark, part, f"{root}/silver")
        refresh_candles(spark, stored(spark, f"{root}/silver"), touched_buckets(part, BUCKET), f"{root}/candles", AS_OF, TZ,
                        LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS)
    return stored(spark, f"{root}/candles")


def q_incremental_snapshot(spark, d):
    """The snapshot of day states that followed two rounds of late corrections."""
    from candlewick.operators.incremental import refresh_day_states, snapshot_from_states, touched_buckets
    from candlewick.sources.tables import merge_silver, stored
    root = scratch_path(spark, "states")
    for part in _corrections(silver_table(spark, d, "user")):
        merge_silver(spark, part, f"{root}/silver")
        refresh_day_states(spark, stored(spark, f"{root}/silver"), touched_buckets(part, BUCKET), f"{root}/days", AS_OF, TZ,
                           LOOKBACK_DAYS)
    c = gold_candles(stored(spark, f"{root}/silver"), AS_OF, TZ, LOOKBACK_DAYS, BUCKET, 4, SMA_DIGITS)
    return snapshot_from_states(stored(spark, f"{root}/days"), c, dim(spark, d), AS_OF, TZ, LOOKBACK_DAYS)


def q_merge_bucketed(spark, d):
    """The target and a high-water slice merged in buckets of their key."""
    from candlewick.sources.bucketed import create_bucketed, merge_bucketed
    _, target, sl = _target_and_slice(spark, d)
    path = scratch_path(spark, "buckets")
    name = "lake.silver_" + path.rsplit("-", 1)[-1]
    create_bucketed(spark, target, name, path, spark.sparkContext.defaultParallelism)
    merge_bucketed(spark, silver_quotes(sl, TZ), name)
    return spark.table(name)


# --- streams with state ----------------------------------------------------------------------

FEED_CUTS = ("2024-01-11 13:00:00", "2024-01-20 12:00:00")   # in the middle of trading days


def _timed_feed(spark, s, src):
    """Silver ticks as three deliveries in time order, and a clock tick long after
    them; returns the functions that append the files of each."""
    cuts = ["0001-01-01 00:00:00", *FEED_CUTS, "9999-01-01 00:00:00"]
    ts = F.col("quote_ts")
    parts = [s.filter((ts >= _at(a)) & (ts < _at(b))) for a, b in zip(cuts, cuts[1:])]
    clock = s.limit(1).withColumn("ticker", F.lit("~clock")).withColumn("quote_ts", _at("2024-06-01 00:00:00"))
    return [lambda p=p: p.write.mode("append").parquet(src) for p in [*parts, clock]]


def _stream_ticks(spark, d, work, late=None):
    """The ticks of the feed through a stateful stream that is stopped after each
    delivery, in the middle of a day, and started again; what it appended, without
    the clock. A delivery is one micro-batch, of as many files as it has."""
    from candlewick.streaming.bronze_stream import await_or_raise
    from candlewick.streaming.stateful import start_append, stateful_session
    src, out, chk = (scratch_path(spark, n) for n in ("ticks_src", "ticks_out", "ticks_chk"))
    s = silver_table(spark, d)
    session = stateful_session(spark, spark.sparkContext.defaultParallelism)
    put = _timed_feed(spark, s, src)
    for deliver in (*put[:3], *([lambda: late(s).write.mode("append").parquet(src)] if late else []), put[3]):
        deliver()
        ticks = session.readStream.schema(s.schema).parquet(src)
        await_or_raise(start_append(work(ticks), out, chk, available_now=True))
    return spark.read.parquet(out)


def q_stream_running_state(spark, d):
    """W09 by a stream with a state and timers per instrument, restarted in mid-day."""
    from candlewick.streaming.stateful import running_state
    out = _stream_ticks(spark, d, lambda t: running_state(t, tz=TZ))
    return out.select("ticker", "trading_date", "quote_ts", "price", "day_open", "day_high", "day_low", "ticks_so_far",
                      "volume_so_far", "volume_sum_so_far")


def q_stream_candles(spark, d):
    """Candles emitted as the watermark closes them; ticks later than it are dropped."""
    from candlewick.streaming.stateful import candles_stream
    late = lambda s: s.filter(F.col("quote_ts") < _at(FEED_CUTS[0])).withColumn("price", F.col("price") + 1000.0)
    out = _stream_ticks(spark, d, candles_stream, late)
    return out.select("ticker", "window_start", "open_price", "high_price", "low_price", "close_price", "n_ticks",
                      "volume_cumulative", "source")


def q_stream_deliver_once(spark, d):
    """Silver from a stream in which every event is delivered twice."""
    from candlewick.functions.timeutil import utc_instant
    from candlewick.sources.kafka import quote_stream
    from candlewick.streaming.bronze_stream import await_or_raise
    from candlewick.streaming.stateful import deliver_once, start_append, stateful_session
    src, out, chk = (scratch_path(spark, n) for n in ("twice_src", "twice_bronze", "twice_chk"))
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    # Row groups of 16 MB: several tasks can read a file.
    put = lambda r: r.write.mode("append").option("parquet.block.size", 1 << 24).parquet(src)
    put(rec)
    put(spark.read.parquet(src))   # the second delivery, encoded once
    session = stateful_session(spark, spark.sparkContext.defaultParallelism, count_rows=False)
    stream = to_bronze(quote_stream(session, "parquet", src, maxBytesPerTrigger=STREAM_BATCH), as_of=AS_OF, tz=TZ)
    # The whole month is one delivery: copies come within it.
    await_or_raise(start_append(deliver_once(stream, "40 days"), out, chk, ["ingestion_date"], available_now=True))
    return spark.read.parquet(out).groupBy("ingestion_date", "ticker").agg(F.count(F.lit(1)).alias("n_rows"))


def q_stream_schema_growth(spark, d):
    """A bronze stream restarted with an event schema that has one more field."""
    from pyspark.sql.types import StructType
    from candlewick.functions.timeutil import utc_instant
    from candlewick.schemas import QUOTE_SCHEMA
    from candlewick.sources.kafka import quote_stream
    from candlewick.sources.tables import read_table
    from candlewick.streaming.bronze_stream import await_or_raise, start_bronze
    src, out, chk = (scratch_path(spark, n) for n in ("grow_src", "grow_bronze", "grow_chk"))
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    older = StructType([f for f in QUOTE_SCHEMA if f.name != "market_cap"])
    for schema, part in ((older, F.col("offset") % 2 == 0), (QUOTE_SCHEMA, F.col("offset") % 2 == 1)):
        rec.filter(part).write.mode("append").parquet(src)
        await_or_raise(start_bronze(quote_stream(spark, "parquet", src, maxBytesPerTrigger=STREAM_BATCH), out, chk,
                                    available_now=True, tz=TZ, schema=schema))
    return read_table(spark, out).drop("processing_ts")


def _damaged_records(spark, d):
    """Kafka records of which some are no JSON, have no ticker or no value, and
    some offsets are missing."""
    from candlewick.functions.timeutil import utc_instant
    k = F.col("offset") % 50
    value = (F.when(k == 7, F.concat(F.lit("{"), "value")).when(k == 8, F.regexp_replace("value", '"ticker"', '"tick"'))
             .when(k == 9, "").otherwise(F.col("value")))
    rec = kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp"))
    return rec.withColumn("value", value).filter(~(F.col("offset") % 97).isin(13, 14, 60))


def q_dead_letters(spark, d):
    """Records that bronze drops, and why."""
    from candlewick.sources.kafka import dead_letters
    return dead_letters(_damaged_records(spark, d)).drop("kafka_ts", "value")


def q_offset_gaps(spark, d):
    """Holes in each partition's offsets (a ticker's offsets are a partition's own
    only in parts here, so the feed itself has holes as well)."""
    from candlewick.sources.kafka import offset_gaps
    r = _damaged_records(spark, d).select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))
    return offset_gaps(r, block=1024)


def q_repeated_offsets(spark, d):
    """Offsets that were delivered twice."""
    from candlewick.sources.kafka import repeated_offsets
    r = _damaged_records(spark, d).select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))
    return repeated_offsets(r.unionByName(r.filter(F.col("kafka_offset") % 10 == 3)))


def q_stream_split(spark, d):
    """Bronze, dead letters and gaps from one stream of two batches, the second
    after a restart: rows per output."""
    from candlewick.sources.kafka import quote_stream
    from candlewick.streaming.bronze_stream import await_or_raise, start_bronze_split
    src, out, dead, gaps, chk = (scratch_path(spark, n) for n in ("split_src", "split_bronze", "split_dead", "split_gaps", "split_chk"))
    rec = _damaged_records(spark, d).withColumn("offset", F.col("offset").cast("long"))
    half = rec.agg(F.max("offset")).first()[0] // 2
    for part in (F.col("offset") <= half, F.col("offset") > half):
        rec.filter(part).write.mode("append").parquet(src)
        await_or_raise(start_bronze_split(quote_stream(spark, "parquet", src, maxBytesPerTrigger=STREAM_BATCH), out, dead, gaps,
                                          chk, available_now=True, tz=TZ))
    n = lambda df, kind: df.agg(F.lit(kind).alias("output"), F.count(F.lit(1)).alias("n_rows"))
    return n(spark.read.parquet(out), "bronze").unionByName(n(spark.read.parquet(dead), "dead letters")).unionByName(
        n(spark.read.parquet(gaps), "gaps"))


def q_stream_heartbeat(spark, d):
    """The last heartbeat of a stream: all rows counted, none late."""
    from candlewick.functions.timeutil import utc_instant
    from candlewick.sources.kafka import quote_stream
    from candlewick.streaming.bronze_stream import ProgressLog, await_or_raise, heartbeat, progress_frame, start_bronze
    src, out, chk, log = (scratch_path(spark, n) for n in ("beat_src", "beat_bronze", "beat_chk", "beat"))
    kafka_records(events(spark, d), "type").withColumn("timestamp", utc_instant("timestamp")).write.parquet(src)
    listener = ProgressLog(log)
    spark.streams.addListener(listener)
    try:
        qy = start_bronze(quote_stream(spark, "parquet", src, maxFilesPerTrigger=2), out, chk, available_now=True, tz=TZ)
        await_or_raise(qy)
        listener.wait(qy)
    finally:
        spark.streams.removeListener(listener)
    return heartbeat(progress_frame(spark, log)).groupBy("query").agg(
        F.max_by("rows_so_far", "batch_id").alias("rows_so_far"), F.max_by("late_so_far", "batch_id").alias("late_so_far"),
        (F.max_by("mean_rate", "batch_id") > 0).alias("has_rate"))


# --- anomalies, compaction, widening, ad-hoc totals --------------------------------------------

ANOMALY = {"size": "6 hours", "slide": "1 hour", "threshold": 3.0, "min_ticks": 5}


def q_price_anomalies(spark, d):
    """Prices far from the median of the six hours that end in their hour."""
    from candlewick.operators.anomalies import price_anomalies
    return price_anomalies(ticks(spark, d, "type"), **ANOMALY)


def q_anomaly_alerts(spark, d):
    """The anomalies as alert records on the wire."""
    from candlewick.operators.anomalies import anomaly_alerts
    a = anomaly_alerts(q_price_anomalies(spark, d), "run-" + AS_OF[:10], AS_OF.replace(" ", "T") + "+00:00")
    return encode_events(a.select("severity", "task_id", "run_id"), key="task_id")


def q_compact_fragmented(spark, d):
    """A table of which the second day is in many files: compaction rewrites that
    day and no other, and a second run rewrites nothing."""
    from candlewick.sources.tables import compact, file_sizes, record_schema, stored
    path = scratch_path(spark, "fragmented")
    s = silver_table(spark, d)
    second = s.select("trading_date").distinct().orderBy("trading_date").limit(2).agg(F.max("trading_date")).scalar()
    s.filter(F.col("trading_date") != second).repartition("trading_date").write.partitionBy("trading_date").parquet(path)
    s.filter(F.col("trading_date") == second).repartition(12).write.mode("append").partitionBy("trading_date").parquet(path)
    record_schema(spark, path, s.schema)
    before = materialize(file_sizes(spark, path, ["trading_date"]), "files_before")
    compact(spark, path, "trading_date")
    again = compact(spark, path, "trading_date")
    after = file_sizes(spark, path, ["trading_date"]).select("trading_date", "file").join(
        before.select("file", F.lit(True).alias("same")), "file", "left")
    kept = after.groupBy("trading_date").agg(F.bool_and(F.coalesce("same", F.lit(False))).alias("untouched"))
    rows = stored(spark, path).groupBy("trading_date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("volume").alias("volume"))
    return rows.join(kept, "trading_date").withColumn("second_run_files", F.lit(again))


def q_merge_widening(spark, d):
    """Three merges on disk: offsets as int and dates, then as long and times, then
    as int and dates again; then compaction over the mixed files."""
    from candlewick.sources.tables import compact, merge_into, stored
    s, first, last = _days(spark, d)
    day, path = F.col("trading_date"), scratch_path(spark, "widening")
    s = s.withColumn("seen", F.col("ingestion_ts"))
    narrow = lambda df: df.withColumn("kafka_offset", F.col("kafka_offset").cast("int")).withColumn(
        "seen", F.col("ingestion_ts").cast("date"))
    merge_into(spark, narrow(s.filter(day == F.lit(first))), path)
    merge_into(spark, s.filter(day > F.lit(first)).withColumn("kafka_offset", F.col("kafka_offset") + (1 << 40)), path)
    merge_into(spark, narrow(s.filter((day == F.lit(last)) & (F.col("kafka_offset") % 2 == 0))).withColumn(
        "ingestion_ts", F.col("ingestion_ts") + F.expr("INTERVAL 1 DAY")), path)
    compact(spark, path, "trading_date")
    return stored(spark, path).select("ticker", "quote_ts", "kafka_offset", "seen")


def q_top_movers_total(spark, d):
    """How many rows the ad-hoc query has, beside the fifty it shows."""
    from candlewick.sources.tables import show_query
    view = "movers_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    snapshot(spark, d).createOrReplaceTempView(view)
    _, total = show_query(spark, f"SELECT ticker, change_pct FROM {view}", 50)
    spark.catalog.dropTempView(view)
    return total


QUERIES = {
    "bronze_decode": q_bronze_decode,
    "api_normalize": q_api_normalize,
    "silver_filter": q_silver_filter,
    "silver_change_pct": q_silver_change_pct,
    "silver_feed_delay": q_silver_feed_delay,
    "silver_dedup": q_silver_dedup,
    "silver_incremental_slice": q_silver_incremental_slice,
    "silver_merge": q_silver_merge,
    "silver_schema_evolution": q_silver_schema_evolution,
    "candles_ohlcv": q_candles_ohlcv,
    "candles_lag_volume_delta": q_candles_lag_volume_delta,
    "candles_return": q_candles_return,
    "candles_sma": q_candles_sma,
    "candles_volatility": q_candles_volatility,
    "candles_full": q_candles_full,
    "intraday_running_state": q_intraday_running_state,
    "latest_tick": q_latest_tick,
    "latest_candle": q_latest_candle,
    "day_aggregate": q_day_aggregate,
    "snapshot_full": q_snapshot_full,
    "day_range_position": q_day_range_position,
    "sector_performance": q_sector_performance,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "dq_between": q_dq_between,
    "dq_unique_combination": q_dq_unique_combination,
    "dq_fresh": q_dq_fresh,
    "dq_ohlc": q_dq_ohlc,
    "dq_no_future": q_dq_no_future,
    "dq_freshness_levels": q_dq_freshness_levels,
    "run_summary": q_run_summary,
    "coverage_missing": q_coverage_missing,
    "market_session": q_market_session,
    "live_board": q_live_board,
    "staleness_class": q_staleness_class,
    "source_mode": q_source_mode,
    "trailing_horizon": q_trailing_horizon,
    "board_display": q_board_display,
    "sector_ranking": q_sector_ranking,
    "dim_seed": q_dim_seed,
    "compaction_roundtrip": q_compaction_roundtrip,
    "stream_bronze_counts": q_stream_bronze_counts,
    "event_encode": q_event_encode,
    "stream_silver_upsert": q_stream_silver_upsert,
    "stream_progress": q_stream_progress,
    "gated_build": q_gated_build,
    "silver_incremental_build": q_silver_incremental_build,
    "alerts": q_alerts,
    "ops_log_tail": q_ops_log_tail,
    "stream_age": q_stream_age,
    "distinct_tickers": q_distinct_tickers,
    "candle_direction": q_candle_direction,
    "top_movers": q_top_movers,
    "registered_bronze": q_registered_bronze,
    "merge_evolution_on_disk": q_merge_evolution_on_disk,
    "full_refresh_replaces": q_full_refresh_replaces,
    "merge_into_table": q_merge_into_table,
    "compact_streamed": q_compact_streamed,
    "candles_source_mixed": q_candles_source_mixed,
    "planted_bad_values": q_planted_bad_values,
    "run_record": q_run_record,
    "alerts_log": q_alerts_log,
    "run_results_read": q_run_results_read,
    "incremental_gold": q_incremental_gold,
    "provenance": q_provenance,
    "snapshot_by_ticker": q_snapshot_by_ticker,
    "sectors_ascending": q_sectors_ascending,
    "candles_minute": q_candles_minute,
    "bootstrap_empty": q_bootstrap_empty,
    "run_artifacts": q_run_artifacts,
    "incremental_corrections": q_incremental_corrections,
    "incremental_snapshot": q_incremental_snapshot,
    "merge_bucketed": q_merge_bucketed,
    "stream_running_state": q_stream_running_state,
    "stream_candles": q_stream_candles,
    "stream_deliver_once": q_stream_deliver_once,
    "stream_schema_growth": q_stream_schema_growth,
    "dead_letters": q_dead_letters,
    "offset_gaps": q_offset_gaps,
    "repeated_offsets": q_repeated_offsets,
    "stream_split": q_stream_split,
    "stream_heartbeat": q_stream_heartbeat,
    "price_anomalies": q_price_anomalies,
    "anomaly_alerts": q_anomaly_alerts,
    "compact_fragmented": q_compact_fragmented,
    "merge_widening": q_merge_widening,
    "top_movers_total": q_top_movers_total,
}
