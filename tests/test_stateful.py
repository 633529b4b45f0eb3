"""Streams with state: batch = stream, bounded state, late rows counted, restarts."""

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators.anomalies import anomaly_alerts, price_anomalies
from candlewick.operators.candles import intraday_running_state, ohlcv
from candlewick.schemas import ALERT_SCHEMA
from candlewick.sources.kafka import dead_letters, offset_gaps, quote_stream, repeated_offsets, to_bronze
from candlewick.streaming.bronze_stream import await_or_raise, start_bronze_split, start_silver_upsert
from candlewick.streaming.stateful import candles_stream, deliver_once, running_state, start_append, stateful_session
from tests.helpers import event, kafka_df, rows, silver_df

TZ = "America/Sao_Paulo"


@pytest.fixture(scope="module")
def session(spark):
    return stateful_session(spark, 2)


def _ticks(spark, n=120, day=2, tickers=("A", "B"), step=60):
    start = datetime(2024, 1, day, 13)
    return silver_df(spark, [dict(ticker=t, quote_ts=str(start + timedelta(seconds=step * i)), price=10.0 + (7 * i) % 11,
                                  volume=None if i < 3 and t == "B" else 100 + i, event_id=f"{t}{day}-{i}", kafka_offset=i)
                             for t in tickers for i in range(n)])


def _run(session, schema, src, out, chk, work):
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_append(work(stream), out, chk, available_now=True)
    await_or_raise(q)
    return [p for p in q.recentProgress if p.stateOperators]


def test_state_falls_and_late_ticks_are_counted(spark, session, tmp):
    src, out, chk = f"{tmp}/src", f"{tmp}/out", f"{tmp}/chk"
    day = _ticks(spark)
    put = lambda df: df.coalesce(1).write.mode("append").parquet(src)
    order = F.col("quote_ts") < F.lit("2024-01-02 14:00:00").cast("timestamp_ntz")
    put(day.filter(order).orderBy(F.rand(1)))                    # out of order inside a delivery
    work = lambda s: running_state(s, "5 minutes", TZ)
    _run(session, day.schema, src, out, chk, work)
    put(day.filter(~order))                                      # restarted in mid-day
    put(_ticks(spark, 3, tickers=("C",)).withColumn("quote_ts", F.expr("quote_ts - INTERVAL 2 HOURS")))   # too late
    clock = _ticks(spark, 1, day=9, tickers=("~",))
    put(clock)
    progress = _run(session, day.schema, src, out, chk, work)
    got, exp = spark.read.parquet(out), intraday_running_state(day)
    assert rows(got.select(*exp.columns)) == rows(exp)
    assert sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators) == 3
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in progress]
    assert held[-1] <= 2 < max(held)                             # midnight passed: only the clock's tick waits


def test_closed_candles_equal_batch_and_late_ticks_change_nothing(spark, session, tmp):
    src, out, chk = f"{tmp}/src", f"{tmp}/out", f"{tmp}/chk"
    day = _ticks(spark, 60, step=20)
    late = day.withColumn("price", F.lit(999.0))
    # A batch's late rows are judged by the watermark before it: two clock ticks close the day.
    clock = lambda d: _ticks(spark, 1, day=d, tickers=("~",))
    for part in (day, clock(5), clock(6), late, clock(9)):
        part.coalesce(1).write.mode("append").parquet(src)
    progress = _run(session, day.schema, src, out, chk, candles_stream)
    got, exp = spark.read.parquet(out).filter("ticker <> '~'"), ohlcv(day)
    assert rows(got.select(*exp.columns)) == rows(exp)
    assert sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators) > 0


def test_repeated_deliveries_go_and_their_state_falls(spark, session, tmp):
    src, out, chk = f"{tmp}/src", f"{tmp}/out", f"{tmp}/chk"
    at = lambda m: f"2024-01-02T13:{m:02d}:00.000Z"
    evs = [event(ticker=f"T{i % 3}", event_id=None if i == 4 else f"e{i}", quote_ts=at(i), ingestion_ts=at(i)) for i in range(20)]
    first = kafka_df(spark, evs)
    again = kafka_df(spark, evs[10:])                            # same ids, delivered again
    far = kafka_df(spark, [event(event_id="far", ingestion_ts="2024-01-03T13:00:00.000Z")], start_offset=500)
    schema = to_bronze(first).schema
    for part in (first, again.withColumn("offset", F.col("offset") + 10), far):
        to_bronze(part).coalesce(1).write.mode("append").parquet(src)
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_append(deliver_once(stream, "10 minutes"), out, chk, ["ingestion_date"], available_now=True)
    await_or_raise(q)
    got = spark.read.parquet(out)
    assert sorted(r.event_id or "" for r in got.collect()) == sorted([e["event_id"] or "" for e in evs] + ["far"])
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in q.recentProgress if p.stateOperators]
    assert held[-1] < max(held)
    silver = f"{tmp}/silver"
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    await_or_raise(start_silver_upsert(stream, silver, f"{tmp}/chk2", available_now=True, deliver_once_within="10 minutes"))
    from candlewick.operators.silver import silver_quotes
    assert rows(spark.read.parquet(silver).select("ticker", "quote_ts", "price")) == rows(
        silver_quotes(spark.read.parquet(src)).select("ticker", "quote_ts", "price"))


def test_deliver_once_query_keeps_its_state_on_disk(spark, tmp, monkeypatch):
    from candlewick.plans import catalog
    at = {}
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: at.setdefault(name, f"{tmp}/{name}"))
    start = datetime(2024, 1, 2, 13)
    spark.createDataFrame([(i, start + timedelta(hours=7 * i), i % 3, ("click", "view")[i % 2], 10.0 + i, '{"k": 1}') for i in range(40)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp}/events.parquet")
    got = catalog.q_stream_deliver_once(spark, tmp)
    exp = to_bronze(spark.read.parquet(at["twice_src"]).distinct(), tz=TZ).groupBy("ingestion_date", "ticker").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect())) and got.agg(F.sum("n_rows")).first()[0] == 120
    copies = spark.read.parquet(at["twice_src"]).groupBy("value", "partition", "offset", "timestamp").count()
    assert {r["count"] for r in copies.collect()} == {2} and copies.count() == 120
    state = f"{at['twice_chk']}/state/0"
    parts = [p for p in os.listdir(state) if p.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism
    names = [f for p in parts for f in os.listdir(f"{state}/{p}")]
    assert any(f.endswith(".zip") for f in names) and not any(f.endswith(".delta") for f in names)


def _payloads():
    return [event(), "{broken", "[1, 2]", "", None, "{}", '{"ticker": null, "price": 1}', event(ticker="X", price="38.5"), "null",
            '{"ticker": "Y", "price": "abc"}']


def test_bronze_and_dead_letters_are_the_whole_input(spark):
    df = spark.createDataFrame([((p if isinstance(p, str) or p is None else __import__("json").dumps(p)), 0, i,
                                 datetime(2024, 1, 2)) for i, p in enumerate(_payloads())],
                               "value string, partition int, offset long, timestamp timestamp")
    dead = {r.kafka_offset: r.reason for r in dead_letters(df).collect()}
    kept = {r.kafka_offset for r in to_bronze(df).collect()}
    assert kept | dead.keys() == set(range(len(_payloads()))) and not kept & dead.keys()
    assert dead == {1: "malformed", 2: "malformed", 3: "empty", 4: "empty", 5: "no ticker", 6: "no ticker",
                    8: dead[8]} and kept == {0, 7, 9}


def test_split_stream_replays_without_adding(spark, tmp):
    src, out, dead, gaps, chk = (f"{tmp}/{n}" for n in ("src", "bronze", "dead", "gaps", "chk"))
    rec = spark.createDataFrame([("{bad" if i % 5 == 0 else __import__("json").dumps(event(event_id=str(i))), i % 2, o, datetime(2024, 1, 2))
                                 for i, o in enumerate([0, 0, 1, 1, 2, 2, 7, 3, 8, 4, 9, 9, 12, 12])],
                                "value string, partition int, offset long, timestamp timestamp")
    go = lambda: await_or_raise(start_bronze_split(
        quote_stream(spark, "parquet", src, maxFilesPerTrigger=1), out, dead, gaps, chk, available_now=True))
    early = F.col("offset") < 8
    rec.filter(early).coalesce(1).write.parquet(src)
    go()
    rec.filter(~early).coalesce(1).write.mode("append").parquet(src)
    go()
    seen = lambda: (spark.read.parquet(out).count(), spark.read.parquet(dead).count(),
                    rows(spark.read.parquet(gaps).select("kafka_partition", "gap_start", "gap_end", "missing")))
    first = seen()
    assert first[0] + first[1] == 14
    assert first[2] == [(0, 10, 11, 2), (0, 3, 6, 4), (1, 10, 11, 2), (1, 5, 8, 4)]
    for f in (f"{chk}/commits/1", f"{chk}/commits/.1.crc"):      # the last batch is not known to have ended
        os.remove(f)
    go()
    assert seen() == first


def test_offset_gaps_against_brute_force(spark):
    rng = np.random.default_rng(4)
    kept = {(p, int(o)) for p in (0, 1) for o in rng.choice(300, 220, replace=False)} | {(2, 5)}
    df = spark.createDataFrame([k for k in kept for _ in range(1 + k[1] % 2)] + [(None, 3), (1, None)],
                               "kafka_partition int, kafka_offset long")
    expect = []
    for p in (0, 1, 2):
        o = sorted(x for q, x in kept if q == p)
        expect += [(p, a + 1, b - 1, b - a - 1) for a, b in zip(o, o[1:]) if b > a + 1]
    for block in (1, 16, 1 << 16):
        assert sorted(tuple(r) for r in offset_gaps(df, block=block).collect()) == sorted(expect)
    last = spark.createDataFrame([(0, 250), (7, 1)], "kafka_partition int, last_offset long")
    got = {tuple(r) for r in offset_gaps(df, last, 16).collect() if r.kafka_partition == 0}
    o = [250] + sorted(x for q, x in kept if q == 0 and x > 250)
    assert got == {(0, a + 1, b - 1, b - a - 1) for a, b in zip(o, o[1:]) if b > a + 1}
    assert {r.copies for r in repeated_offsets(df.where("kafka_partition IS NOT NULL")).collect()} == {2}


def test_anomalies_against_brute_force(spark):
    rng = np.random.default_rng(1)
    start = datetime(2024, 1, 2, 13)
    ticks = [("A", start + timedelta(seconds=int(s)), float(np.round(rng.normal(10, 0.3), 1))) for s in rng.integers(0, 7200, 400)]
    ticks += [("A", start + timedelta(minutes=37), 50.0)] * 2 + [("FLAT", start + timedelta(seconds=i), 3.0) for i in range(30)]
    ticks += [("FEW", start + timedelta(seconds=i), float(i)) for i in range(4)] + [("A", start, None)]
    df = spark.createDataFrame(ticks, "ticker string, quote_ts timestamp_ntz, price double")
    got = {(r.ticker, r.window_end, r.price): (r.median_price, r.mad, r.score, r.n_ticks)
           for r in price_anomalies(df, "30 minutes", "5 minutes", 3.0, 10).collect()}
    expect = {}
    known = [t for t in ticks if t[2] is not None]
    for name, at, price in known:
        end = at.replace(minute=at.minute // 5 * 5, second=0) + timedelta(minutes=5)
        window = [p for n, a, p in known if n == name and end - timedelta(minutes=30) <= a < end]
        m = float(np.median(window))
        mad = float(np.median(np.abs(np.array(window) - m)))
        if len(window) >= 10 and mad > 0 and abs(price - m) / (1.4826 * mad) > 3.0:
            same = sum(n == name and p == price and end - timedelta(minutes=5) <= a < end for n, a, p in known)
            expect[name, end, price] = (m, mad, round(abs(price - m) / (1.4826 * mad), 4), same)
    assert got.keys() == expect.keys() and ("A", start + timedelta(minutes=40), 50.0) in got
    for k, v in got.items():
        assert v == pytest.approx(expect[k], abs=2e-4)
    alerts = anomaly_alerts(price_anomalies(df, "30 minutes", "5 minutes", 3.0, 10), "r", "now")
    assert alerts.columns == ALERT_SCHEMA.names and alerts.first().severity == "warning"
    with pytest.raises(ValueError):
        price_anomalies(df, "30 minutes", "7 minutes")
