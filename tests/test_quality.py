from datetime import datetime

from pyspark.sql import functions as F

from candlewick.operators import quality as q
from candlewick.plans.batch_run import alerts_from, run_summary
from candlewick.plans.checks import evaluate, offending, silver_suite
from tests.helpers import silver_df

AS_OF = "2024-01-02 20:00:00"


def _clean(spark):
    return silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 13:00:00", price=10.0, change_pct=1.0),
                             dict(ticker="B", quote_ts="2024-01-02 13:00:00", price=20.0, change_pct=-2.0)])


def test_not_null_unique_accepted(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    assert q.not_null(df, "v").count() == 1
    assert [tuple(r) for r in q.unique(df, "k").collect()] == [("a", 2)]
    assert q.unique(df.filter("k = 'b'"), "k").count() == 0
    acc = q.accepted_values(df, "k", ["a"]).collect()
    assert [tuple(r) for r in acc] == [("b", 1)]                  # NULL ignored


def test_relationships_and_between(spark):
    child = spark.createDataFrame([("A",), ("Z",), (None,), ("Z",)], "ticker string")
    parent = spark.createDataFrame([("A",)], "ticker string")
    assert [r.from_field for r in q.relationships(child, "ticker", parent, "ticker").collect()] == ["Z", "Z"]
    v = spark.createDataFrame([(0.01,), (5000.0,), (0.0,), (5000.5,), (None,), (0.0,)], "p double")
    assert sorted(tuple(r) for r in q.between(v, "p", 0.01, 5000).collect()) == [(0.0, 2), (5000.5, 1)]


def test_unique_combination(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2)], "t string, q int")
    assert [tuple(r) for r in q.unique_combination(df, ["t", "q"]).collect()] == [("A", 1, 2)]


def test_freshness_checks(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 19, 50),)], "ingestion_ts timestamp_ntz")
    assert q.assert_fresh(df, as_of=AS_OF).count() == 0
    stale = q.assert_fresh(df, as_of="2024-01-02 20:30:00").first()
    assert stale.staleness_seconds == 40 * 60
    empty = q.assert_fresh(df.limit(0), as_of=AS_OF).collect()
    assert len(empty) == 1 and empty[0].last_ingestion_ts is None   # empty input is a violation
    lv = [q.freshness(df, as_of=a).first().status for a in
          ("2024-01-02 19:54:00", "2024-01-02 20:00:00", "2024-01-02 20:11:00")]
    assert lv == ["pass", "warn", "error"]
    assert q.freshness(df.limit(0), as_of=AS_OF).first().status == "error"


def test_ohlc_and_future(spark):
    c = spark.createDataFrame([("A", 1, 10.0, 12.0, 9.0, 11.0), ("B", 1, 10.0, 10.5, 9.0, 11.0),
                               ("C", 1, 10.0, 12.0, 10.5, 11.0), ("D", 1, 10.0, 8.0, 9.0, 10.0)],
                              "ticker string, window_start int, open_price double, high_price double, "
                              "low_price double, close_price double")
    assert sorted(r.ticker for r in q.assert_ohlc(c).collect()) == ["B", "C", "D"]
    s = silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 20:05:00", price=1.0),
                          dict(ticker="B", quote_ts="2024-01-02 20:05:01", price=1.0)])
    assert [r.ticker for r in q.assert_no_future(s, as_of=AS_OF).collect()] == ["B"]


def test_every_silver_check_fails_on_a_planted_row(spark):
    """Each check passes on clean data and fails once a violating row is added."""
    clean = _clean(spark)
    dim = spark.createDataFrame([("A",), ("B",)], "ticker string")
    bronze = clean.withColumn("ingestion_ts", F.lit(AS_OF).cast("timestamp_ntz"))
    base = {"silver": clean, "bronze": bronze, "dim_tickers": dim}
    res = {r.unique_id: r.status for r in evaluate(silver_suite(), base, AS_OF).collect()}
    assert set(res.values()) == {"pass"}, res
    bad_row = dict(ticker="Q", quote_ts="2024-01-03 13:00:00", price=9000.0, change_pct=50.0, source="other",
                   volume=-1)
    planted = clean.unionByName(silver_df(spark, [bad_row]))
    planted = planted.unionByName(planted.limit(1))                      # duplicate key
    planted = planted.unionByName(silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 13:01:00", price=1.0)])
                                  .withColumn("event_id", F.lit(None).cast("string")))
    stale_bronze = bronze.withColumn("ingestion_ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    nulls = bronze.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in (
        "event_id", "ticker", "price", "ingestion_ts", "source") else F.col(f.name) for f in bronze.schema])
    bad = {"silver": planted, "bronze": stale_bronze.unionByName(nulls).unionByName(
        silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 13:00:00", price=0.0, source="x")]).withColumn(
            "ingestion_ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))), "dim_tickers": dim}
    res = {r.unique_id: r.status for r in evaluate(silver_suite(), bad, AS_OF).collect()}
    never_failing = {"test.silver.silver_not_null_ticker", "test.silver.silver_not_null_quote_ts",
                     "test.silver.silver_not_null_ingestion_ts", "test.silver.silver_not_null_price",
                     "test.silver.silver_not_null_source", "test.silver.silver_not_null_trading_date"}
    for uid, st in res.items():
        if uid not in never_failing:
            assert st == "fail", uid
    # the remaining not-null checks fail on their own planted NULL
    for c in silver_suite():
        if c.unique_id in never_failing:
            df = clean.withColumn(c.column, F.lit(None).cast(clean.schema[c.column].dataType))
            assert offending(c, {"silver": df}).count() == 2


def test_fused_evaluation_equals_separate(spark):
    s = _clean(spark).unionByName(silver_df(spark, [dict(ticker="Q", quote_ts="2024-01-02 13:00:00", price=0.0)]))
    t = {"silver": s, "bronze": s, "dim_tickers": spark.createDataFrame([("A",)], "ticker string")}
    fused = {r.unique_id: r.status for r in evaluate(silver_suite(), t, AS_OF).collect()}
    single = {c.unique_id: ("pass" if offending(c, t, AS_OF).count() == 0 else "fail") for c in silver_suite()}
    assert fused == single


def test_run_summary_and_alerts(spark):
    res = spark.createDataFrame(
        [("model.silver_quotes", "silver", "success"), ("test.silver.a", "silver", "pass"),
         ("test.silver.b", "silver", "fail"), ("test.silver.c", "silver", "warn"), ("seed.dim", "seed", "success"),
         ("model.gold_x", "gold", "success"), ("test.gold.d", "gold", "error"), ("test.gold.e", "gold", "pass")],
        "unique_id string, layer string, status string")
    s = {r.layer: r for r in run_summary(res).collect()}
    assert (s["silver"].models, s["silver"].tests_pass, s["silver"].tests_fail, s["silver"].tests_warn) == (1, 1, 1, 1)
    assert s["gold"].tests_fail == 1 and s["gold"].errors == 1 and s["gold"].status == "falha"
    assert s["seed"].seeds == 1 and s["seed"].status == "ok"
    t = s["total"]
    assert (t.models, t.seeds, t.tests_pass, t.tests_fail, t.tests_warn, t.errors) == (2, 1, 2, 2, 1, 1)
    al = alerts_from(res, run_id="r1", detected_at="2024-01-02T20:00:00+00:00").collect()
    assert sorted(a.exception for a in al) == ["test.gold.d error", "test.silver.b fail"]
    assert {a.severity for a in al} == {"error"}
