"""Quote feed derived from the generic ``events`` table.

The test tables carry no market data, so this adaptor turns each event into
quote readings, the way the polling producer would publish them: every event
is read three times (15 s apart, 30 min after the quote), and the readings
are serialised as Kafka records. Mapping (fixed, shared with the SQL oracle):

  ticker          event_type (``by="type"``) or user_id as text (``by="user"``)
  quote_ts        ts (UTC), millisecond precision on the wire
  ingestion_ts    ts + 30 min + 15 s * k,  k = 0, 1, 2
  price           value; 0 for the third reading when props.k = 0 (API glitch)
  previous_close  props.k
  day_open        value + (event_id % 3) * 0.1 - 0.1
  day_high        value + (event_id % 7) * 0.25
  day_low         value - value * (event_id % 5) * 0.1
  volume          event_id * 100 (cumulative: event_id grows with ts)
  change_pct_api  (value / props.k - 1) * 100, NULL when props.k = 0
  market_cap      value * 1e6, NULL for simulated readings
  source          'simulated' when event_id % 10 = 0, else 'brapi'
  kafka offset    event_id * 3 + k;  partition = length(ticker) % 3
  event_id        text of the offset

The dimension comes from ``customer`` joined to ``nation``: ticker = customer
key, company_name = c_name, sector = c_mktsegment, b3_index = n_name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import DEFAULT_CURRENCY, MARKET_TZ, as_of_col
from candlewick.functions.timeutil import bucket_start, iso_utc, market_date
from candlewick.schemas import BRONZE_COLUMNS, QUOTE_SCHEMA


def ticker_expr(by: str):
    if by == "type":
        return F.col("event_type")
    if by == "user":
        return F.col("user_id").cast("string")
    raise ValueError("by must be 'type' or 'user'")


def _readings(events: DataFrame, by: str) -> DataFrame:
    # JSON and the truncated quote time are evaluated per event, below the explode, not per reading.
    e = events.select(
        "event_id", "ts", "value", ticker_expr(by).alias("ticker"), bucket_start("ts", "1 millisecond").alias("__quote_ts"),
        F.get_json_object("props", "$.k").cast("double").alias("pk")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    eid = F.col("event_id")
    value = F.col("value")
    simulated = (eid % 10) == 0
    delay = F.expr("INTERVAL '30' MINUTE + k * INTERVAL '15' SECOND")
    ingestion = F.col("ts") + delay
    return e.select(
        (eid * 3 + F.col("k")).cast("string").alias("event_id"),
        "ticker",
        F.upper("ticker").alias("short_name"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.when((F.col("k") == 2) & (F.col("pk") == 0), F.lit(0.0)).otherwise(value).alias("price"),
        F.col("pk").alias("previous_close"),
        (value + (eid % 3).cast("double") * 0.1 - 0.1).alias("day_open"),
        (value + (eid % 7).cast("double") * 0.25).alias("day_high"),
        (value - value * (eid % 5).cast("double") * 0.1).alias("day_low"),
        (eid * 100).alias("volume"),
        F.when(F.col("pk") != 0, (value / F.col("pk") - 1) * 100).alias("change_pct_api"),
        F.when(~simulated, value * 1e6).alias("market_cap"),
        iso_utc("ts").alias("quote_ts"),
        iso_utc(ingestion).alias("ingestion_ts"),
        F.when(simulated, "simulated").otherwise("brapi").alias("source"),
        F.concat(F.lit("cycle-"), F.col("k").cast("string")).alias("poll_cycle_id"),
        (eid * 3 + F.col("k")).alias("__offset"),
        ingestion.alias("__kafka_ts"),
        "__quote_ts",
        (F.col("__quote_ts") + delay).alias("__ingestion_ts"),   # whole milliseconds later: truncated like the quote
    )


def bronze_rows(events: DataFrame, by: str = "type", as_of=None, tz: str = MARKET_TZ) -> DataFrame:
    """The readings as typed bronze rows, as a bronze *table* holds them.

    Equal to ``to_bronze(kafka_records(events))`` (the wire carries
    millisecond timestamps, hence the truncation) without the JSON round
    trip, which only the ingest path pays.
    """
    r = _readings(events, by)
    return r.select(
        *[c for c in QUOTE_SCHEMA.fieldNames() if c not in ("quote_ts", "ingestion_ts")],
        F.col("__quote_ts").alias("quote_ts"), F.col("__ingestion_ts").alias("ingestion_ts"),
        (F.length("ticker") % 3).cast("int").alias("kafka_partition"),
        F.col("__offset").alias("kafka_offset"),
        F.col("__kafka_ts").alias("kafka_ts"),
        as_of_col(as_of).alias("processing_ts"),
        market_date("__ingestion_ts", tz).alias("ingestion_date"),
    ).select(*BRONZE_COLUMNS)


def kafka_records(events: DataFrame, by: str = "type") -> DataFrame:
    """Kafka-shaped records (value, partition, offset, timestamp) of the readings."""
    r = _readings(events, by)
    payload = F.to_json(F.struct(*[F.col(f.name) for f in QUOTE_SCHEMA.fields]))
    return r.select(payload.alias("value"),
                    (F.length("ticker") % 3).cast("int").alias("partition"),
                    F.col("__offset").alias("offset"),
                    F.col("__kafka_ts").alias("timestamp"))


def api_payloads(events: DataFrame, by: str = "type") -> DataFrame:
    """One API response per event (one ticker per call, as on the free plan),
    numbers serialised as text; ``request_id`` identifies the call."""
    e = events.select("event_id", "ts", "value", ticker_expr(by).alias("ticker"),
                      F.get_json_object("props", "$.k").alias("pk"))
    item = F.struct(
        F.col("ticker").alias("symbol"),
        F.upper("ticker").alias("shortName"),
        F.concat(F.upper("ticker"), F.lit(" S.A.")).alias("longName"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.col("value").cast("string").alias("regularMarketPrice"),
        F.col("pk").alias("regularMarketPreviousClose"),
        (F.col("event_id") * 100).cast("string").alias("regularMarketVolume"),
        iso_utc("ts").alias("regularMarketTime"),
    )
    return e.select(F.col("event_id").alias("request_id"),
                    iso_utc(F.col("ts") + F.make_dt_interval(mins=F.lit(30))).alias("ingestion_ts"),
                    F.to_json(F.struct(F.array(item).alias("results"))).alias("payload"))


def dim_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Reference dimension keyed like the ``by="user"`` tickers."""
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customer.join(n, "c_nationkey", "left").select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.col("n_name").alias("b3_index"))
