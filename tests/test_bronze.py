import json
from datetime import date, datetime

from pyspark.sql import functions as F

from candlewick.schemas import BRONZE_COLUMNS
from candlewick.sources.api import missing_tickers, normalize_api
from candlewick.sources.events_feed import bronze_rows, kafka_records
from candlewick.sources.kafka import empty_bronze, encode_events, to_bronze
from tests.helpers import event, kafka_df


def test_decode_edge_cases(spark):
    payloads = [
        event(ticker="PETR4"),                                   # valid
        "{not json",                                             # malformed -> dropped
        json.dumps([event(ticker="VALE3")]),                     # top-level array -> dropped
        {k: v for k, v in event().items() if k != "ticker"},     # missing ticker -> dropped
        {**event(ticker="ITUB4"), "unexpected": 1},              # unknown field ignored
        event(ticker="MGLU3", price="38.5"),                     # price as quoted string -> NULL
        event(ticker="BBAS3", volume=12.5),                      # fractional volume -> NULL
        event(ticker="WEGE3", quote_ts="31/01/2024 10:00"),      # bad quote_ts -> NULL
        event(ticker="B3SA3", quote_ts=1706662923),              # epoch number -> text -> NULL
        event(ticker="ABEV3", ingestion_ts=None),                # null ingestion_ts -> null partition
    ]
    b = to_bronze(kafka_df(spark, payloads), as_of="2024-01-02 14:00:00")
    assert b.columns == BRONZE_COLUMNS
    got = {r.ticker: r for r in b.collect()}
    assert set(got) == {"PETR4", "ITUB4", "MGLU3", "BBAS3", "WEGE3", "B3SA3", "ABEV3"}
    p = got["PETR4"]
    assert p.quote_ts == datetime(2024, 1, 2, 13, 0) and p.ingestion_ts == datetime(2024, 1, 2, 13, 30)
    assert p.ingestion_date == date(2024, 1, 2) and p.processing_ts == datetime(2024, 1, 2, 14, 0)
    assert p.kafka_offset == 0 and p.kafka_partition == 0
    assert got["MGLU3"].price is None and got["MGLU3"].previous_close == 38.0
    assert got["BBAS3"].volume is None and got["BBAS3"].price == 38.5
    assert got["WEGE3"].quote_ts is None
    assert got["B3SA3"].quote_ts is None
    assert got["ABEV3"].ingestion_ts is None and got["ABEV3"].ingestion_date is None


def test_ingestion_date_is_market_local(spark):
    b = to_bronze(kafka_df(spark, [event(ingestion_ts="2024-01-31T01:00:00.000Z")]))
    assert b.first().ingestion_date == date(2024, 1, 30)


def test_empty_bootstrap_schema_equals_stream_schema(spark):
    e = empty_bronze(spark)
    full = to_bronze(kafka_df(spark, [event()]))
    assert e.schema == full.schema and e.count() == 0


def test_typed_feed_equals_decoded_feed(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = to_bronze(kafka_records(ev, "type"), as_of="2024-01-31 00:00:00")
    b = bronze_rows(ev, "type", as_of="2024-01-31 00:00:00")
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_encode_decode_roundtrip(spark):
    b = to_bronze(kafka_df(spark, [event(ticker="PETR4"), event(ticker="VALE3", price=61.2)]))
    enc = encode_events(b.select("ticker", "price"))
    assert sorted(r.key for r in enc.collect()) == ["PETR4", "VALE3"]
    back = enc.select(F.from_json("value", "ticker string, price double").alias("v")).select("v.*")
    assert sorted(map(tuple, back.collect())) == [("PETR4", 38.5), ("VALE3", 61.2)]


def _payload(results):
    return json.dumps({"results": results})


def test_normalize_api_rules(spark):
    full = {"symbol": "PETR4", "shortName": "PETROBRAS", "longName": "Petroleo Brasileiro", "currency": "BRL",
            "regularMarketPrice": 38.5, "regularMarketPreviousClose": 38.0, "regularMarketVolume": 12345,
            "regularMarketTime": "2024-01-02T13:00:00.000Z"}
    rows = [
        (1, _payload([full])),
        (2, _payload([])),                                                         # empty results
        (3, _payload([{**full, "symbol": None}])),                                 # missing symbol -> dropped
        (4, _payload([{**full, "symbol": "VALE3", "shortName": None}])),           # -> long name
        (5, _payload([{**full, "symbol": "ITUB4", "regularMarketPrice": "n/a"}])),  # -> NULL price
        (6, _payload([{**full, "symbol": "MGLU3", "regularMarketVolume": None, "currency": None}])),
    ]
    df = spark.createDataFrame(rows, "request_id long, payload string")
    out = normalize_api(df, cycle_col=None, event_id=F.col("request_id").cast("string"),
                        ingestion_ts=F.lit("2024-01-02T13:30:00.000Z"))
    got = {r.ticker: r for r in out.collect()}
    assert set(got) == {"PETR4", "VALE3", "ITUB4", "MGLU3"}
    assert got["PETR4"].price == 38.5 and got["PETR4"].volume == 12345 and got["PETR4"].event_id == "1"
    assert got["VALE3"].short_name == "Petroleo Brasileiro"
    assert got["ITUB4"].price is None
    assert got["MGLU3"].volume == 0 and got["MGLU3"].currency == "BRL"
    assert got["PETR4"].source == "brapi" and got["PETR4"].quote_ts == "2024-01-02T13:00:00.000Z"


def test_missing_tickers(spark):
    req = spark.createDataFrame([("PETR4",), ("VALE3",), ("ITUB4",)], "ticker string")
    got = spark.createDataFrame([("PETR4",), (None,)], "ticker string")
    assert [r.ticker for r in missing_tickers(req, got).orderBy("ticker").collect()] == ["ITUB4", "VALE3"]
