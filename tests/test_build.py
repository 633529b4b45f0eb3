"""The batch build end to end: clean data passes every suite and reaches gold;
planted bad gold rows fail their checks; a failing silver suite stops the build."""

from pyspark.sql import functions as F

from candlewick.config import scratch_path
from candlewick.plans.batch_run import build, run_summary
from candlewick.plans.checks import evaluate, gold_suite
from candlewick.sources.kafka import to_bronze
from tests.helpers import event, kafka_df

AS_OF = "2024-01-02 14:00:00"


def _clean_bronze(spark, spread_minutes=1):
    evs = []
    for t, p in (("PETR4", 38.5), ("VALE3", 61.2), ("ITUB4", 35.8)):
        for i in range(6):
            ing = 55 - spread_minutes * (5 - i)
            evs.append(event(ticker=t, price=p + i * 0.1, previous_close=p, day_open=p, day_high=p + 0.6,
                             day_low=p - 0.1, volume=1000 + i,
                             quote_ts=f"2024-01-02T13:0{i}:00.000Z", ingestion_ts=f"2024-01-02T13:{ing}:00.000Z"))
    return to_bronze(kafka_df(spark, evs), as_of=AS_OF)


def _dim(spark):
    return spark.createDataFrame([("PETR4", "Petrobras", "Oil", "IBOV"), ("VALE3", "Vale", "Mining", "IBOV"),
                                  ("ITUB4", "Itau", "Banks", "IBOV")],
                                 "ticker string, company_name string, sector string, b3_index string")


def test_clean_build_reaches_gold_and_passes(spark):
    tables, res = build(spark, _clean_bronze(spark), _dim(spark), scratch_path(spark, "t_build"), AS_OF,
                        lookback_days=5, gate=True)
    statuses = {r.unique_id: r.status for r in res.collect()}
    assert "model.gold_sector_performance" in statuses
    assert all(s in ("pass", "success") for s in statuses.values()), [k for k, v in statuses.items()
                                                                        if v not in ("pass", "success")]
    total = {r.layer: r for r in run_summary(res).collect()}["total"]
    assert total.status == "ok" and total.models == 4 and total.seeds == 1 and total.tests_fail == 0
    assert tables["candles"].count() == 18 and tables["snapshot"].count() == 3 and tables["sectors"].count() == 3

    # plant one bad row per gold table: its checks must fail
    c, s, sec = tables["candles"], tables["snapshot"], tables["sectors"]
    bad_c = c.limit(1).withColumn("high_price", F.lit(1.0)).withColumn("open_price", F.lit(9000.0)) \
        .withColumn("source", F.lit("other")).withColumn("ticker", F.lit("XXXX3"))
    bad_s = s.limit(1).withColumn("company_name", F.lit(None).cast("string")) \
        .withColumn("day_range_position_pct", F.lit(101.0)).withColumn("change_pct", F.lit(31.0))
    bad_sec = sec.limit(1).withColumn("avg_change_pct", F.lit(-30.5))
    planted = {**tables, "candles": c.unionByName(bad_c), "snapshot": s.unionByName(bad_s),
               "sectors": sec.unionByName(bad_sec)}
    got = {r.unique_id: r.status for r in evaluate(gold_suite(), planted, AS_OF).collect()}
    for uid in ("candles_ohlc_coherent", "candles_between_open", "candles_accepted_source",
                "candles_relationships_ticker", "snapshot_not_null_company_name", "snapshot_unique_ticker",
                "snapshot_between_range_position", "snapshot_between_change_pct", "sectors_unique_sector",
                "sectors_between_avg_change_pct"):
        assert got[f"test.gold.{uid}"] == "fail", uid


def test_failing_silver_stops_before_gold(spark):
    bad = _clean_bronze(spark).withColumn("previous_close", F.lit(1.0))       # change_pct far beyond +-30
    tables, res = build(spark, bad, _dim(spark), scratch_path(spark, "t_gate"), AS_OF, lookback_days=5, gate=True)
    layers = {r.layer for r in res.collect()}
    assert layers == {"seed", "silver"} and "candles" not in tables
    assert {r.layer: r.status for r in run_summary(res).collect()}["total"] == "falha"


def test_failing_model_and_suite_become_errors_and_are_logged(spark):
    from candlewick.schemas import ALERT_SCHEMA, RUN_SCHEMA
    from candlewick.sources.oplog import tail_json
    root = scratch_path(spark, "t_error")
    broken = _clean_bronze(spark).drop("price")                   # the silver model cannot run
    tables, res = build(spark, broken, _dim(spark), root, AS_OF, run_id="r1", logical_date="2024-01-02")
    by = {r.unique_id: r.status for r in res.collect()}
    assert by["model.silver_quotes"] == "error" and by["seed.dim_tickers"] == "success"
    assert not any(k.startswith("model.gold") for k in by) and "silver" not in tables
    bad_dim = _dim(spark).drop("sector")                          # a suite that cannot run
    _, res = build(spark, _clean_bronze(spark), bad_dim, root, AS_OF, run_id="r2", logical_date="2024-01-02")
    assert {r.status for r in res.collect() if r.unique_id.startswith("test.seed")} == {"error"}
    runs = {r.run_id: r for r in tail_json(spark, root + "/logs/runs", RUN_SCHEMA, "finished_at", 5, tie=["run_id"]).collect()}
    assert runs["r1"].status == runs["r2"].status == "falha" and runs["r1"].errors == 1
    assert runs["r2"].layers["seed"].errors == 4 and runs["r1"].elapsed_seconds > 0
    alerts = spark.read.schema(ALERT_SCHEMA).json(root + "/logs/alerts").collect()
    assert sorted(a.run_id for a in alerts) == ["r1"] + ["r2"] * 4


def test_incremental_builds_equal_full_build(spark):
    from tests.helpers import rows
    b = _clean_bronze(spark, spread_minutes=5)                    # readings 13:30 .. 13:55
    root = scratch_path(spark, "t_incr")
    first = b.filter(F.col("ingestion_ts") < F.lit("2024-01-02 13:47:00").cast("timestamp_ntz"))
    t1, _ = build(spark, first, _dim(spark), root, AS_OF, lookback_days=5, incremental=True)
    assert t1["silver"].count() == 12
    t2, res = build(spark, b, _dim(spark), root, AS_OF, lookback_days=5, incremental=True)
    assert t2["bronze"].count() < b.count()                      # bronze checks ran on the slice only
    full, _ = build(spark, b, _dim(spark), scratch_path(spark, "t_full"), AS_OF, lookback_days=5)
    drop = ["processing_ts"]
    assert rows(t2["silver"].drop(*drop)) == rows(full["silver"].drop(*drop))
    assert rows(t2["snapshot"].drop("refreshed_at")) == rows(full["snapshot"].drop("refreshed_at"))


def test_duplicated_dimension_key_stops_before_gold(spark):
    dup = _dim(spark).unionByName(_dim(spark).limit(1))
    tables, res = build(spark, _clean_bronze(spark), dup, scratch_path(spark, "t_dup"), AS_OF, lookback_days=5)
    st = {r.unique_id: r.status for r in res.collect()}
    assert st["test.seed.dim_unique_ticker"] == "fail" and "snapshot" not in tables
