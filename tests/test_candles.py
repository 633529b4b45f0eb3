import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators.candles import gold_candles, intraday_running_state, ohlcv
from candlewick.schemas import CANDLE_COLUMNS
from tests.helpers import rows, silver_df


def _ticks(spark):
    # 13:00Z = 10:00 local. Two ticks in the first minute, a gap minute, a volume correction downwards.
    r = [
        dict(ticker="A", quote_ts="2024-01-02 13:00:10", price=10.0, volume=100, feed_delay_seconds=1800),
        dict(ticker="A", quote_ts="2024-01-02 13:00:50", price=10.5, volume=150, feed_delay_seconds=1801),
        dict(ticker="A", quote_ts="2024-01-02 13:00:30", price=9.5, volume=120, feed_delay_seconds=1800,
             source="simulated"),
        dict(ticker="A", quote_ts="2024-01-02 13:02:00", price=11.0, volume=140),   # volume corrected down
        dict(ticker="A", quote_ts="2024-01-02 13:03:00", price=11.0, volume=300),
        dict(ticker="A", quote_ts="2024-01-03 13:00:00", price=20.0, volume=50),    # next trading day
        dict(ticker="B", quote_ts="2024-01-02 13:00:00", price=5.0, volume=10),
    ]
    return silver_df(spark, r)


def test_ohlcv_bucket(spark):
    c = {(r.ticker, r.window_start): r for r in ohlcv(_ticks(spark), "1 minute").collect()}
    a = c[("A", datetime(2024, 1, 2, 13, 0))]
    assert (a.open_price, a.high_price, a.low_price, a.close_price) == (10.0, 10.5, 9.5, 10.5)
    assert a.n_ticks == 3 and a.volume_cumulative == 150 and a.avg_feed_delay_seconds == 1800.3
    assert a.source == "simulated"            # max(source): one simulated tick taints the candle
    assert c[("B", datetime(2024, 1, 2, 13, 0))].source == "brapi"


def test_window_metrics_semantics(spark):
    g = gold_candles(_ticks(spark), as_of="2024-01-03 20:00:00", tz="America/Sao_Paulo", lookback_days=5)
    assert g.columns == CANDLE_COLUMNS
    a = [r for r in g.filter("ticker = 'A'").orderBy("window_start").collect()]
    # first candle of each day: delta 0, return NULL
    assert a[0].volume_delta == 0 and a[0].return_pct is None
    assert a[1].volume_delta == 0                                # 140 - 150 floored at 0
    assert a[2].volume_delta == 160
    assert a[1].return_pct == round((11.0 / 10.5 - 1) * 100, 4)
    assert a[0].volatility_pct_20 is None and a[1].volatility_pct_20 is None   # needs two returns
    assert a[2].volatility_pct_20 == 0.0 or a[2].volatility_pct_20 is not None
    assert a[1].sma_9 == round((10.5 + 11.0) / 2, 4)             # averages what exists, gaps skipped
    assert a[3].trading_date != a[2].trading_date and a[3].volume_delta == 0 and a[3].return_pct is None
    assert a[3].sma_9 == 20.0                                    # windows never cross dates


def test_lookback_excludes_old_days(spark):
    g = gold_candles(_ticks(spark), as_of="2024-01-09 12:00:00", tz="America/Sao_Paulo", lookback_days=5)
    assert g.count() == 0
    g6 = gold_candles(_ticks(spark), as_of="2024-01-08 12:00:00", tz="America/Sao_Paulo", lookback_days=5)
    assert {r.trading_date.day for r in g6.collect()} == {3}     # today and the 5 days before


def test_sma_and_volatility_over_many_candles(spark):
    rnd = random.Random(3)
    base = datetime(2024, 1, 2, 13, 0)
    r = [dict(ticker="A", quote_ts=(base + timedelta(minutes=i)).isoformat(sep=" "),
              price=round(10 + rnd.random(), 2), volume=i) for i in range(45)]
    g = gold_candles(silver_df(spark, r), as_of="2024-01-02 20:00:00", tz="America/Sao_Paulo").orderBy(
        "window_start").collect()
    closes = [x["price"] for x in r]
    rets = [None] + [round((closes[i] / closes[i - 1] - 1) * 100, 4) for i in range(1, 45)]
    import statistics
    for i in (0, 5, 8, 19, 30, 44):
        w9 = closes[max(0, i - 8): i + 1]
        w20 = closes[max(0, i - 19): i + 1]
        assert abs(g[i].sma_9 - round(sum(w9) / len(w9), 4)) < 1e-9
        assert abs(g[i].sma_20 - round(sum(w20) / len(w20), 4)) < 1e-9
        rr = [x for x in rets[max(0, i - 19): i + 1] if x is not None]
        exp = round(statistics.stdev(rr), 4) if len(rr) >= 2 else None
        assert (g[i].volatility_pct_20 is None) == (exp is None)
        if exp is not None:
            assert abs(g[i].volatility_pct_20 - exp) < 1e-4


def test_running_state_equals_plain_window(spark):
    rnd = random.Random(11)
    base = datetime(2024, 1, 2, 12, 0)
    r = [dict(ticker=rnd.choice("AB"), quote_ts=(base + timedelta(seconds=rnd.randint(0, 30 * 3600))).isoformat(
        sep=" ") + f".{i:06d}", price=round(rnd.uniform(5, 15), 2), volume=rnd.randint(0, 10_000)) for i in range(400)]
    t = silver_df(spark, r)
    got = intraday_running_state(t, chunk="1 minute")
    w = Window.partitionBy("ticker", "trading_date").orderBy("quote_ts").rowsBetween(Window.unboundedPreceding, 0)
    exp = t.select("ticker", "trading_date", "quote_ts", "price",
                   F.first("price").over(w).alias("day_open"), F.max("price").over(w).alias("day_high"),
                   F.min("price").over(w).alias("day_low"),
                   F.row_number().over(Window.partitionBy("ticker", "trading_date").orderBy("quote_ts"))
                   .cast("long").alias("ticks_so_far"),
                   F.max("volume").over(w).alias("volume_so_far"),
                   F.sum("volume").over(w).alias("volume_sum_so_far"))
    assert rows(got) == rows(exp)
