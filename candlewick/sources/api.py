"""Quote API payload normalisation (S11) and response coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.config import DEFAULT_CURRENCY, as_of_col
from candlewick.functions.quotes import safe_double
from candlewick.functions.timeutil import iso_utc
from candlewick.schemas import API_PAYLOAD_SCHEMA


def normalize_api(payloads: DataFrame, payload_col: str = "payload", cycle_col: str | None = "poll_cycle_id",
                  event_id: Column | None = None, ingestion_ts: Column | None = None,
                  source: str = "brapi") -> DataFrame:
    """API responses (JSON text) -> canonical wire events, one per ``results[]`` item.

    ``event_id`` / ``ingestion_ts`` may be expressions over the payload row's
    other columns (e.g. a request id); by default a random UUID and now.

    Field rules: short name falls back to the long name, currency to 'BRL',
    volume to 0; numeric text that does not parse becomes NULL instead of
    failing the whole poll. Items without a symbol are dropped.
    """
    keep = [c for c in payloads.columns if c != payload_col]
    items = (payloads
             .select(*keep, F.explode(F.from_json(F.col(payload_col), API_PAYLOAD_SCHEMA)["results"]).alias("r"))
             .filter(F.col("r.symbol").isNotNull() & (F.trim("r.symbol") != "")))
    r = lambda n: F.col(f"r.{n}")
    blank_null = lambda c: F.nullif(F.trim(c), F.lit(""))
    ing = ingestion_ts if ingestion_ts is not None else iso_utc(as_of_col(None))
    return items.select(
        (event_id if event_id is not None else F.uuid()).alias("event_id"),
        r("symbol").alias("ticker"),
        F.coalesce(blank_null(r("shortName")), blank_null(r("longName"))).alias("short_name"),
        F.coalesce(blank_null(r("currency")), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        safe_double(r("regularMarketPrice")).alias("price"),
        safe_double(r("regularMarketPreviousClose")).alias("previous_close"),
        safe_double(r("regularMarketOpen")).alias("day_open"),
        safe_double(r("regularMarketDayHigh")).alias("day_high"),
        safe_double(r("regularMarketDayLow")).alias("day_low"),
        # Whole numbers stay exact beyond 2^53; NaN and numbers out of range count as absent.
        F.coalesce(r("regularMarketVolume").try_cast("long"), safe_double(r("regularMarketVolume")).try_cast("long"),
                   F.lit(0).cast("long")).alias("volume"),
        safe_double(r("regularMarketChangePercent")).alias("change_pct_api"),
        safe_double(r("marketCap")).alias("market_cap"),
        r("regularMarketTime").alias("quote_ts"),
        ing.alias("ingestion_ts"),
        F.lit(source).alias("source"),
        (F.col(cycle_col) if cycle_col and cycle_col in payloads.columns else F.lit(None).cast("string"))
        .alias("poll_cycle_id"),
    )


def missing_tickers(requested: DataFrame, returned: DataFrame, key: str = "ticker",
                    returned_key: str | None = None) -> DataFrame:
    """Requested keys absent from the response (set difference as an anti-join)."""
    rk = returned_key or key
    got = returned.select(F.col(rk).alias(key)).filter(F.col(key).isNotNull())
    return requested.join(got, on=key, how="left_anti")
