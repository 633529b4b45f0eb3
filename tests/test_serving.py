from datetime import datetime

from candlewick.operators import serving
from tests.helpers import rows


def _bronze(spark):
    return spark.createDataFrame([
        ("A", 10.0, "brapi", datetime(2024, 1, 2, 13, 0), 1, "2024-01-02"),
        ("A", None, "simulated", datetime(2024, 1, 2, 13, 5), 2, "2024-01-02"),   # newest price NULL
        ("A", 11.0, None, datetime(2024, 1, 2, 13, 5), 1, "2024-01-02"),          # same ts, lower offset
        ("B", 5.0, "brapi", datetime(2024, 1, 1, 13, 0), 3, "2024-01-01"),
    ], "ticker string, price double, source string, ingestion_ts timestamp_ntz, kafka_offset long, "
       "ingestion_date string")


def test_live_latest_per_column(spark):
    lv = {r.ticker: r for r in serving.live_latest(_bronze(spark), cols=("price", "source")).collect()}
    assert lv["A"].price == 11.0 and lv["A"].source == "simulated"
    assert [r.ticker for r in serving.live_latest(_bronze(spark), cols=("price",), since_date="2024-01-02").collect()] == ["A"]


def test_live_board_overlay(spark):
    snap = spark.createDataFrame([("A", 9.0, 10.0, 150.0, "brapi"), ("C", 7.0, 0.0, None, "brapi")],
                                 "ticker string, last_price double, previous_close double, "
                                 "day_range_position_pct double, source string")
    live = serving.live_latest(_bronze(spark), cols=("price", "source"))
    b = {r.ticker: r for r in serving.live_board(snap, live).collect()}
    assert b["A"].price == 11.0 and b["A"].price_origin == "bronze"
    assert abs(b["A"].change_pct_live - 10.0) < 1e-9 and b["A"].direction == "up"
    assert b["A"].range_marker_pct == 100.0
    assert b["C"].price == 7.0 and b["C"].price_origin == "gold" and b["C"].change_pct_live is None
    assert b["C"].direction == "flat" and b["C"].range_marker_pct == 0.0


def test_source_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("A", "simulated"), ("A", "brapi"), ("B", "simulated"), ("B", "simulated"),
                                ("B", "brapi")], "ticker string, source string")
    assert rows(serving.source_mode(df, by=["ticker"])) == [("A", "brapi"), ("B", "simulated")]


def test_trailing_horizon_relative_to_series_max(spark):
    c = spark.createDataFrame([("A", datetime(2024, 1, 2, h)) for h in (1, 5, 8, 9)] +
                              [("B", datetime(2024, 1, 3, 1))], "ticker string, window_start timestamp_ntz")
    got = rows(serving.trailing_horizon(c, 6))
    assert got == [("A", datetime(2024, 1, 2, 5)), ("A", datetime(2024, 1, 2, 8)), ("A", datetime(2024, 1, 2, 9)),
                   ("B", datetime(2024, 1, 3, 1))]
    assert serving.trailing_horizon(c, None).count() == 5


def test_stream_age_falls_back_to_snapshot(spark):
    snap = spark.createDataFrame([(datetime(2024, 1, 2, 12, 0),)], "last_ingestion_ts timestamp_ntz")
    live = spark.createDataFrame([], "ingestion_ts timestamp_ntz")
    r = serving.stream_age(live, snap, as_of="2024-01-02 12:01:30").first()
    assert r.age_seconds == 90
    live2 = spark.createDataFrame([(datetime(2024, 1, 2, 12, 1),)], "ingestion_ts timestamp_ntz")
    assert serving.stream_age(live2, snap, as_of="2024-01-02 12:01:30").first().age_seconds == 30


def test_ordered_views_and_newest(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("c", 1)], "ticker string, ts int")
    assert [r.ticker for r in serving.ordered(df, "ticker").collect()] == ["a", "b", "c"]
    assert [r.ticker for r in serving.newest(df, "ts", 2).collect()] == ["a", "b"]
    assert [r.ticker for r in serving.distinct_tickers(df.unionByName(df)).collect()] == ["a", "b", "c"]
    s = spark.createDataFrame([("X", 1.0, 2), ("Y", 3.0, 1), ("Z", 1.0, 5)], "sector string, avg_change_pct double, "
                              "n_tickers int")
    assert [(r.sector, r.position) for r in serving.sector_ranking(s).orderBy("position").collect()] == [
        ("Y", 1), ("X", 2), ("Z", 3)]
