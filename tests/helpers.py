"""Fixture builders: hand-written quote rows in the bronze / silver shapes."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from candlewick.schemas import KAFKA_SHAPE


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def kafka_df(spark, payloads, start_offset=0):
    """Kafka-shaped rows from dicts / raw strings."""
    rows = []
    for i, p in enumerate(payloads):
        value = p if isinstance(p, str) else json.dumps(p)
        rows.append((value, 0, start_offset + i, datetime(2024, 1, 2, 13, 0, 0)))
    return spark.createDataFrame(rows, KAFKA_SHAPE)


def event(ticker="PETR4", price=38.5, quote_ts="2024-01-02T13:00:00.000Z", ingestion_ts="2024-01-02T13:30:00.000Z",
          **kw):
    e = {"event_id": kw.pop("event_id", f"{ticker}-{quote_ts}-{ingestion_ts}"), "ticker": ticker,
         "short_name": ticker, "currency": "BRL", "price": price, "previous_close": 38.0, "day_open": 38.1,
         "day_high": 39.0, "day_low": 37.9, "volume": 1000, "change_pct_api": 1.3, "market_cap": None,
         "quote_ts": quote_ts, "ingestion_ts": ingestion_ts, "source": "brapi", "poll_cycle_id": "c1"}
    e.update(kw)
    return e


SILVER_DDL = ("event_id string, ticker string, short_name string, currency string, quote_ts timestamp_ntz, "
              "ingestion_ts timestamp_ntz, processing_ts timestamp_ntz, price double, previous_close double, "
              "day_open double, day_high double, day_low double, volume bigint, change_pct_api double, "
              "change_pct double, feed_delay_seconds int, source string, kafka_partition int, kafka_offset bigint, "
              "trading_date date")


def silver_df(spark, rows):
    """rows: dicts with at least ticker, quote_ts, price; the rest defaulted."""
    from candlewick.functions.timeutil import market_date
    full = []
    for i, r in enumerate(rows):
        q = ts(r["quote_ts"])
        full.append((r.get("event_id", str(i)), r["ticker"], r["ticker"], "BRL", q,
                     ts(r.get("ingestion_ts", r["quote_ts"])), q, float(r["price"]),
                     r.get("previous_close", 10.0), r.get("day_open"), r.get("day_high"), r.get("day_low"),
                     r.get("volume", 100 * (i + 1)), None, r.get("change_pct"), r.get("feed_delay_seconds", 0),
                     r.get("source", "brapi"), 0, r.get("kafka_offset", i), None))
    df = spark.createDataFrame(full, SILVER_DDL)
    return df.withColumn("trading_date", market_date("quote_ts", "America/Sao_Paulo"))


def rows(df, *cols, order=None):
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out


def col_values(df, col):
    return [r[0] for r in df.select(col).collect()]


def lit_ts(s):
    return F.lit(s).cast("timestamp_ntz")
