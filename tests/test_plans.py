"""Physical-plan properties the design relies on at scale."""

from pyspark.sql import functions as F

from candlewick.operators.candles import gold_candles
from candlewick.operators.silver import silver_quotes
from candlewick.plans.checks import evaluate, silver_suite
from candlewick.sources.events_feed import bronze_rows, kafka_records
from candlewick.sources.kafka import to_bronze

EVENTS = "/root/testdata/sf0.001/events.parquet"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _bronze(spark):
    return bronze_rows(spark.read.parquet(EVENTS), "type", as_of="2024-01-31 00:00:00")


def test_json_parsed_once_per_record(spark):
    plan = _plan(to_bronze(kafka_records(spark.read.parquet(EVENTS))))
    assert plan.count("from_json(") == 1


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(silver_quotes(_bronze(spark)))
    lines = [ln for ln in plan.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning" in ln]
    kinds = ["partial" if "Partial" in ln else "final" if "Final" in ln else "exchange" for ln in lines]
    assert kinds.index("partial") > kinds.index("exchange") > kinds.index("final")   # printed top-down


def test_candles_hash_aggregate_and_one_window_exchange(spark):
    plan = _plan(gold_candles(silver_quotes(_bronze(spark)), "2024-01-31 00:00:00", lookback_days=None,
                              bucket="1 hour"))
    # Ticks are hash-aggregated (partial and final); only what is left, a few
    # rows per candle, meets the sort-based maximum of the source text.
    assert plan.count("HashAggregate") >= 2
    assert "SortAggregate" not in plan[plan.index("HashAggregate"):]
    assert plan.split("Aggregate")[0].count("Exchange") <= 1             # all window frames share one shuffle


def test_row_level_checks_are_one_scan_per_table(spark):
    s = silver_quotes(_bronze(spark))
    t = {"silver": s, "bronze": _bronze(spark), "dim_tickers": spark.createDataFrame([("x",)], "ticker string")}
    row_level = [c for c in silver_suite() if c.kind in ("not_null", "between", "accepted_values", "no_future")]
    plan = _plan(evaluate(row_level, t, "2024-01-31 00:00:00"))
    assert plan.count("FileScan parquet") == 2                           # bronze once, silver once


def test_dimension_join_is_not_forced_to_broadcast(spark):
    """Join strategy comes from size estimates / AQE, not from hints in the code."""
    import inspect

    import candlewick.operators.snapshot as snap
    assert "broadcast(" not in inspect.getsource(snap)


def test_results_files_grow_with_their_nodes_and_not_with_all_nodes_times_folders(spark, tmp):
    import glob
    from candlewick.plans import catalog
    n = 2 * catalog.RESULTS_NODES
    spark.range(n).select(F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey"),
                          F.lit(1.0).alias("c_acctbal"), F.when(F.col("id") % 2 == 0, "A").alias("c_mktsegment")).write.parquet(
        f"{tmp}/customer.parquet")
    path = catalog._results_files(spark, tmp).replace("file:", "")
    assert len(glob.glob(f"{path}/*/*/*/*.json")) == 10   # five nations, two segments of which one is NULL
    got = catalog.q_run_results_read(spark, tmp)
    assert got.agg(F.count_distinct("unique_id"), F.count(F.lit(1)), F.min("elapsed_time"), F.max("elapsed_time")).first()[:] == (
        n, n, n / 5, n / 5)


def test_readings_parse_an_event_once(spark):
    plan = _plan(_bronze(spark))
    above, below = plan.split("Generate explode", 1)
    assert "get_json_object" in below and "get_json_object" not in above
    assert "MICROSECOND" in below                                        # the truncated quote time as well


def test_dedup_sorts_by_a_hash_and_derives_columns_afterwards(spark):
    plan = _plan(silver_quotes(_bronze(spark)))
    sorts = [line.split("Sort [", 1)[1] for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 2 and all(s.startswith("__key_hash") for s in sorts)
    below = plan[plan.index("Window ["):]
    assert "change_pct#" not in below and "trading_date" not in below and "feed_delay_seconds" not in below


def test_hashed_top1_keeps_the_same_rows(spark):
    from candlewick.operators.common import top1_per_key
    df = spark.range(200).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("ticker"),   # null keys too
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("quote"), F.pmod(F.col("id") * 37, F.lit(101)).alias("at"), "id")
    order = [F.col("at").desc(), F.col("id").asc()]
    plain, hashed = (top1_per_key(df, ["ticker", "quote"], order, hashed=h) for h in (False, True))
    assert hashed.columns == df.columns and hashed.count() == 35
    assert sorted(map(str, hashed.collect())) == sorted(map(str, plain.collect()))
