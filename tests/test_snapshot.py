from datetime import date, datetime

from candlewick.operators.candles import gold_candles
from candlewick.operators.sectors import sector_performance
from candlewick.operators.snapshot import latest_tick, ticker_snapshot
from candlewick.schemas import SECTOR_COLUMNS, SNAPSHOT_COLUMNS
from tests.helpers import silver_df

AS_OF = "2024-01-02 20:00:00"


def _dim(spark, extra=()):
    rows = [("A", "Alpha SA", "Energy", "IBOV"), ("B", "Beta SA", "Energy", "IBOV"), ("C", "Gamma SA", "Banks", "IBOV")]
    return spark.createDataFrame(rows + list(extra), "ticker string, company_name string, sector string, b3_index string")


def _silver(spark):
    r = [
        dict(ticker="A", quote_ts="2024-01-02 13:00:00", ingestion_ts="2024-01-02 13:30:00", price=10.0,
             previous_close=9.0, day_high=10.0, day_low=9.0, kafka_offset=1),
        # late, older quote ingested last -> becomes the latest state
        dict(ticker="A", quote_ts="2024-01-02 12:59:00", ingestion_ts="2024-01-02 13:40:00", price=9.5,
             previous_close=9.0, day_high=10.0, day_low=9.0, kafka_offset=2),
        dict(ticker="B", quote_ts="2024-01-02 13:00:00", ingestion_ts="2024-01-02 13:30:00", price=20.0,
             previous_close=19.0, day_high=20.0, day_low=20.0, kafka_offset=3),
        dict(ticker="C", quote_ts="2024-01-02 13:00:00", ingestion_ts="2024-01-02 13:31:00", price=30.0,
             previous_close=28.5, day_high=31.0, day_low=29.0, kafka_offset=4),
        dict(ticker="Z", quote_ts="2024-01-02 13:00:00", ingestion_ts="2024-01-02 13:30:00", price=1.0,
             previous_close=1.0, kafka_offset=5),                                    # not in the dimension
        dict(ticker="OLD", quote_ts="2023-12-20 13:00:00", ingestion_ts="2023-12-20 13:30:00", price=1.0,
             kafka_offset=6),                                                        # outside lookback
    ]
    from pyspark.sql import functions as F
    df = silver_df(spark, r)
    return df.withColumn("change_pct", F.round((F.col("price") / F.col("previous_close") - 1) * 100, 4))


def test_latest_is_by_ingestion(spark):
    t = {r.ticker: r for r in latest_tick(_silver(spark)).collect()}
    assert t["A"].quote_ts == datetime(2024, 1, 2, 12, 59) and t["A"].price == 9.5


def test_snapshot(spark):
    s = _silver(spark)
    c = gold_candles(s, AS_OF, lookback_days=5)
    snap = ticker_snapshot(s, c, _dim(spark), AS_OF, lookback_days=5)
    assert snap.columns == SNAPSHOT_COLUMNS
    got = {r.ticker: r for r in snap.collect()}
    assert set(got) == {"A", "B", "C", "Z"}                      # OLD vanished (lookback)
    a = got["A"]
    assert a.company_name == "Alpha SA" and a.last_price == 9.5 and a.change_abs == 0.5
    assert a.day_range_position_pct == 50.0 and a.n_ticks_dia == 2
    assert a.last_candle_window == datetime(2024, 1, 2, 13, 0)
    assert a.seconds_since_last_tick == 6 * 3600 + 20 * 60 and a.trading_date == date(2024, 1, 2)
    assert got["B"].day_range_position_pct is None               # high == low
    assert got["Z"].sector is None                               # unknown ticker kept, no sector
    sec = {r.sector: r for r in sector_performance(snap).collect()}
    assert list(sector_performance(snap).columns) == SECTOR_COLUMNS
    assert set(sec) == {"Energy", "Banks"}                       # Z dropped (no sector)
    e = sec["Energy"]
    assert e.n_tickers == 2 and e.best_ticker == "A" and e.worst_ticker == "B"
    assert e.total_volume == a.volume_cumulative + got["B"].volume_cumulative


def test_sector_ties_go_to_smallest_ticker(spark):
    snap = spark.createDataFrame(
        [("B", "S", 1.0, 10, None, None), ("A", "S", 1.0, 10, None, None), ("C", "S", -1.0, 10, None, None),
         ("D", "S", -1.0, 10, None, None)],
        "ticker string, sector string, change_pct double, volume_cumulative long, volatility_pct_20 double, "
        "refreshed_at timestamp_ntz")
    r = sector_performance(snap).first()
    assert r.best_ticker == "A" and r.worst_ticker == "C" and r.avg_change_pct == 0.0
