"""Table contracts (column names and types)."""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType,
)

# The wire and record contracts; names, types and order must
# equal those of the producers. Times are text here, see parse_utc.
QUOTE_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("ticker", StringType()),
    StructField("short_name", StringType()),
    StructField("currency", StringType()),
    StructField("price", DoubleType()),
    StructField("previous_close", DoubleType()),
    StructField("day_open", DoubleType()),
    StructField("day_high", DoubleType()),
    StructField("day_low", DoubleType()),
    StructField("volume", LongType()),
    StructField("change_pct_api", DoubleType()),
    StructField("market_cap", DoubleType()),
    StructField("quote_ts", StringType()),
    StructField("ingestion_ts", StringType()),
    StructField("source", StringType()),
    StructField("poll_cycle_id", StringType()),
])

# Columns a Kafka source exposes (and the file stand-in must have).
KAFKA_SHAPE = StructType([
    StructField("value", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

BRONZE_COLUMNS = [f.name for f in QUOTE_SCHEMA.fields] + [
    "kafka_partition", "kafka_offset", "kafka_ts", "processing_ts", "ingestion_date"]

SILVER_COLUMNS = [
    "event_id", "ticker", "short_name", "currency", "quote_ts", "ingestion_ts", "processing_ts",
    "price", "previous_close", "day_open", "day_high", "day_low", "volume", "change_pct_api",
    "change_pct", "feed_delay_seconds", "source", "kafka_partition", "kafka_offset", "trading_date"]

CANDLE_COLUMNS = [
    "ticker", "window_start", "open_price", "high_price", "low_price", "close_price", "n_ticks",
    "volume_cumulative", "volume_delta", "return_pct", "sma_9", "sma_20", "volatility_pct_20",
    "avg_feed_delay_seconds", "source", "refreshed_at", "trading_date"]

SNAPSHOT_COLUMNS = [
    "ticker", "company_name", "sector", "b3_index", "last_price", "previous_close", "change_abs",
    "change_pct", "day_open", "day_high", "day_low", "day_range_position_pct", "volume_cumulative",
    "n_ticks_dia", "sma_9", "sma_20", "volatility_pct_20", "last_candle_window", "last_quote_ts",
    "last_ingestion_ts", "feed_delay_seconds", "seconds_since_last_tick", "source", "refreshed_at",
    "trading_date"]

SECTOR_COLUMNS = [
    "sector", "n_tickers", "avg_change_pct", "best_change_pct", "worst_change_pct", "best_ticker",
    "worst_ticker", "total_volume", "avg_volatility_pct_20", "refreshed_at"]

DIM_SCHEMA = StructType([
    StructField("ticker", StringType()),
    StructField("company_name", StringType()),
    StructField("sector", StringType()),
    StructField("b3_index", StringType()),
])

ALERT_SCHEMA = StructType([
    StructField("severity", StringType()),
    StructField("detected_at", StringType()),
    StructField("dag_id", StringType()),
    StructField("task_id", StringType()),
    StructField("run_id", StringType()),
    StructField("try_number", IntegerType()),
    StructField("exception", StringType()),
    StructField("log_url", StringType()),
])

LAYER_COUNTS = StructType([
    StructField("models", LongType()),
    StructField("seeds", LongType()),
    StructField("tests_pass", LongType()),
    StructField("tests_fail", LongType()),
    StructField("tests_warn", LongType()),
    StructField("errors", LongType()),
])

RUN_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("logical_date", StringType()),
    StructField("finished_at", StringType()),
    StructField("models", LongType()),
    StructField("seeds", LongType()),
    StructField("tests_pass", LongType()),
    StructField("tests_fail", LongType()),
    StructField("tests_warn", LongType()),
    StructField("errors", LongType()),
    StructField("elapsed_seconds", DoubleType()),
    StructField("status", StringType()),
    StructField("layers", MapType(StringType(), LAYER_COUNTS)),
])

RUN_RESULTS_SCHEMA = StructType([
    StructField("results", ArrayType(StructType([
        StructField("unique_id", StringType()),
        StructField("status", StringType()),
        StructField("execution_time", DoubleType()),
    ]))),
    StructField("elapsed_time", DoubleType()),
])

# Raw quote API payload; numeric members are read as text and safe-cast.
_API_FIELDS = ["symbol", "shortName", "longName", "currency", "regularMarketPrice",
               "regularMarketPreviousClose", "regularMarketOpen", "regularMarketDayHigh",
               "regularMarketDayLow", "regularMarketVolume", "regularMarketChangePercent", "marketCap",
               "regularMarketTime"]
API_PAYLOAD_SCHEMA = StructType([
    StructField("results", ArrayType(StructType([StructField(n, StringType()) for n in _API_FIELDS]))),
])
