"""Gold that follows its merges: equal to a rebuild, and no more is rewritten than changed."""

import glob
import os

from pyspark.sql import functions as F

from candlewick.config import scratch_path
from candlewick.operators.candles import gold_candles
from candlewick.operators.incremental import HALO, candle_updates, pending_changes, refresh_candles, touched_buckets
from candlewick.plans import batch_run
from candlewick.plans.batch_run import build
from candlewick.sources.tables import materialize, merge_silver, stored
from tests.helpers import rows, silver_df
from tests.test_build import AS_OF as BUILD_AS_OF
from tests.test_build import _clean_bronze, _dim

AS_OF = "2024-01-05 23:00:00"
OPTIONS = {"as_of": AS_OF, "tz": "UTC", "lookback_days": 10, "bucket": "1 minute"}


def _files(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(path.replace("file:", "") + "/**/*.parquet",
                                                                          recursive=True)}


def _day(spark, tickers=("A", "B"), days=(2, 3, 4), minutes=60):
    return silver_df(spark, [dict(ticker=t, quote_ts=f"2024-01-{d:02d} {12 + m // 60:02d}:{m % 60:02d}:00", price=10.0 + (m * 7 + d) % 13,
                                  volume=100 * (m + 1), event_id=f"{t}{d}-{m}")
                             for t in tickers for d in days for m in range(0, minutes, 1)])


def _fresh(spark, silver, by_hour=False):
    root = scratch_path(spark, "t_incremental")
    merge_silver(spark, silver, f"{root}/silver", by_hour)
    refresh_candles(spark, stored(spark, f"{root}/silver"), touched_buckets(silver, "1 minute"), f"{root}/candles",
                    by_hour=by_hour, **OPTIONS)
    return root


def _late(spark, ticker, at, price):
    return silver_df(spark, [dict(ticker=ticker, quote_ts=at, price=price, volume=50, event_id="late", kafka_offset=10_000)])


def test_a_late_tick_rewrites_only_what_looks_back_on_it(spark):
    root = _fresh(spark, _day(spark))
    before = _files(f"{root}/candles")
    late = materialize(_late(spark, "A", "2024-01-03 12:10:30", 99.0), "late")
    merge_silver(spark, late, f"{root}/silver")
    silver = stored(spark, f"{root}/silver")
    n = refresh_candles(spark, silver, touched_buckets(late, "1 minute"), f"{root}/candles", **OPTIONS)
    assert n == HALO + 1                                       # the candle and those whose metrics reach it
    got = stored(spark, f"{root}/candles")
    full = gold_candles(silver, digits=4, **OPTIONS)
    assert rows(got.select(*full.columns)) == rows(full)
    after = _files(f"{root}/candles")
    changed = [f for f in after if before.get(f) != after[f]]
    assert changed and all("2024-01-03" in f for f in changed)
    assert all(before[f] == after[f] for f in before if "2024-01-03" not in f)
    # A slice that brings nothing new writes nothing.
    assert refresh_candles(spark, silver, touched_buckets(late, "1 minute"), f"{root}/candles", **OPTIONS) == 0
    assert _files(f"{root}/candles") == after


def test_by_hour_rewrites_the_hours_it_reaches(spark):
    root = _fresh(spark, _day(spark, days=(2,), minutes=180), by_hour=True)
    before = _files(f"{root}/candles")
    late = materialize(_late(spark, "B", "2024-01-02 12:50:30", 1.0), "late")   # reaches into the next hour
    merge_silver(spark, late, f"{root}/silver", by_hour=True)
    silver = stored(spark, f"{root}/silver")
    refresh_candles(spark, silver, touched_buckets(late, "1 minute"), f"{root}/candles", by_hour=True, **OPTIONS)
    after = _files(f"{root}/candles")
    assert all(before[f] == after.get(f) for f in before if "candle_hour=14" in f)
    assert not any(f in after for f in before if "candle_hour=12" in f or "candle_hour=13" in f)
    full = gold_candles(silver, digits=4, **OPTIONS)
    assert rows(stored(spark, f"{root}/candles").select(*full.columns)) == rows(full)


def test_a_new_candle_between_others_and_days_before_the_lookback(spark):
    silver = _day(spark, tickers=("A",), days=(2,), minutes=30).filter(F.minute("quote_ts") != 15)
    root = _fresh(spark, silver)
    new = materialize(_late(spark, "A", "2024-01-02 12:15:00", 3.0).unionByName(
        _late(spark, "A", "2023-01-02 12:15:00", 3.0)), "new")
    merge_silver(spark, new, f"{root}/silver")
    s = stored(spark, f"{root}/silver")
    refresh_candles(spark, s, touched_buckets(new, "1 minute"), f"{root}/candles", **OPTIONS)
    full = gold_candles(s, digits=4, **OPTIONS)
    assert rows(stored(spark, f"{root}/candles").select(*full.columns)) == rows(full) and full.count() == 30


def test_updates_of_a_null_source_and_prunes_silver(spark):
    root = _fresh(spark, _day(spark, days=(2, 3)).withColumn("source", F.lit(None).cast("string")))
    silver, candles = stored(spark, f"{root}/silver"), stored(spark, f"{root}/candles")
    touched = materialize(touched_buckets(silver.filter("trading_date = DATE'2024-01-02'"), "1 minute"), "touched")
    u = candle_updates(silver, candles, touched, AS_OF)
    assert u.count() == 0                                      # NULL equals NULL
    plan = u._jdf.queryExecution().executedPlan().toString()
    assert "trading_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_gold_catches_up_after_a_gate_stopped_it(spark):
    b = _clean_bronze(spark, spread_minutes=5)
    root = scratch_path(spark, "t_catch_up")
    cut = lambda ts: b.filter(F.col("ingestion_ts") < F.lit(f"2024-01-02 13:{ts}:00").cast("timestamp_ntz"))
    opts = dict(as_of=BUILD_AS_OF, lookback_days=5, incremental=True, reprocess_minutes=0)
    build(spark, cut(37), _dim(spark), root, **opts)
    # The second run's gate stops it after silver; gold lacks its slice.
    stopped, _ = build(spark, cut(47), _dim(spark), root, dim_parent=_dim(spark).limit(1), **opts)
    assert "candles" not in stopped
    assert pending_changes(spark, f"{root}/changes")[0].count() > 0
    last, _ = build(spark, b, _dim(spark), root, **opts)
    full, _ = build(spark, b, _dim(spark), scratch_path(spark, "t_catch_up_full"), BUILD_AS_OF, lookback_days=5)
    for name in ("candles", "snapshot", "sectors"):
        assert rows(last[name].drop("refreshed_at")) == rows(full[name].select(*last[name].columns).drop("refreshed_at")), name
    assert pending_changes(spark, f"{root}/changes")[0].count() == 0


def test_row_checks_are_counted_while_writing(spark, monkeypatch):
    from candlewick.plans.checks import evaluate, gold_suite, seed_suite, silver_suite
    run = []
    monkeypatch.setattr(batch_run, "evaluate", lambda suite, tables, as_of: run.append([c.unique_id for c in suite])
                        or evaluate(suite, tables, as_of))
    bad = _clean_bronze(spark).withColumn("source", F.when(F.col("ticker") == "VALE3", "other").otherwise(F.col("source")))
    tables, results = build(spark, bad, _dim(spark), scratch_path(spark, "t_watch"), BUILD_AS_OF, lookback_days=5, gate=False)
    got = {r.unique_id: r.status for r in results.collect()}
    again = {r.unique_id: r.status for r in evaluate(seed_suite() + silver_suite() + gold_suite(), tables, BUILD_AS_OF).collect()}
    assert {k: v for k, v in got.items() if k.startswith("test.")} == again
    assert got["test.silver.silver_accepted_source"] == got["test.gold.candles_accepted_source"] == "fail"
    scanned = {uid for suite in run for uid in suite}
    silver_rows = {c.unique_id for c in silver_suite() if c.table == "silver" and c.kind not in ("unique_combination", "relationships")}
    assert not scanned & silver_rows and "test.silver.silver_unique_ticker_quote_ts" in scanned
    assert "test.gold.snapshot_not_null_sector" not in scanned and "test.gold.candles_ohlc_coherent" not in scanned
