import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from candlewick.operators.silver import align, incremental_slice, merge_frames, silver_quotes, valid_quotes
from candlewick.schemas import SILVER_COLUMNS
from candlewick.sources.kafka import to_bronze
from tests.helpers import event, kafka_df, rows


def _bronze(spark, evs):
    return to_bronze(kafka_df(spark, evs), as_of="2024-01-02 14:00:00")


def test_validity_filter(spark):
    evs = [event(ticker="A", price=0.0), event(ticker="B", price=-1.0), event(ticker="C", price=None),
           event(ticker="D", quote_ts=None), event(ticker="E", ingestion_ts=None), event(ticker="F")]
    assert [r.ticker for r in valid_quotes(_bronze(spark, evs)).collect()] == ["F"]


def test_dedup_keeps_first_reading(spark):
    q = "2024-01-02T13:00:00.000Z"
    evs = [event(ticker="A", quote_ts=q, ingestion_ts="2024-01-02T13:30:30.000Z", event_id="late"),
           event(ticker="A", quote_ts=q, ingestion_ts="2024-01-02T13:30:00.000Z", event_id="tie-hi"),
           event(ticker="A", quote_ts=q, ingestion_ts="2024-01-02T13:30:00.000Z", event_id="tie-lo")]
    # offsets follow list order: the two equal ingestion_ts readings have offsets 1 and 2
    s = silver_quotes(_bronze(spark, evs))
    assert s.columns == SILVER_COLUMNS
    r = s.collect()
    assert len(r) == 1 and r[0].event_id == "tie-hi" and r[0].kafka_offset == 1


def test_derived_columns(spark):
    evs = [event(ticker="A", price=39.0, previous_close=38.0, quote_ts="2024-01-31T01:00:00.000Z",
                 ingestion_ts="2024-01-31T01:30:00.999Z"),
           event(ticker="B", previous_close=0.0), event(ticker="C", previous_close=None)]
    got = {r.ticker: r for r in silver_quotes(_bronze(spark, evs)).collect()}
    assert got["A"].change_pct == round((39.0 / 38.0 - 1) * 100, 4)
    assert got["A"].feed_delay_seconds == 1800
    assert got["A"].trading_date == date(2024, 1, 30)   # 01:00Z is 22:00 the day before in Sao Paulo
    assert got["B"].change_pct is None and got["C"].change_pct is None


def _random_log(spark, n_tickers=3, n_quotes=40, seed=7):
    """Readings of quotes; each quote is re-read up to 4 times within <= 10 min."""
    rnd = random.Random(seed)
    base = datetime(2024, 1, 2, 13, 0)
    evs = []
    for t in range(n_tickers):
        for i in range(n_quotes):
            q = base + timedelta(minutes=3 * i + t)
            first = q + timedelta(minutes=30)
            for k in range(rnd.randint(1, 4)):
                ing = first + timedelta(seconds=rnd.randint(0, 600) if k else 0)
                evs.append(event(ticker=f"T{t}", price=10 + rnd.random(), quote_ts=q.isoformat() + ".000Z",
                                 ingestion_ts=ing.isoformat() + ".000Z", event_id=f"{t}-{i}-{k}"))
    rnd.shuffle(evs)
    return _bronze(spark, evs)


def test_incremental_runs_equal_full_refresh(spark):
    b = _random_log(spark).cache()
    full = silver_quotes(b)
    cuts = ["2024-01-02 14:00:00", "2024-01-02 14:45:00", "2024-01-02 15:10:00", "2024-01-02 16:30:00"]
    target = silver_quotes(b.filter(F.col("ingestion_ts") < F.lit(cuts[0]).cast("timestamp_ntz")))
    for nxt in cuts[1:] + [None]:
        visible = b if nxt is None else b.filter(F.col("ingestion_ts") < F.lit(nxt).cast("timestamp_ntz"))
        src = silver_quotes(incremental_slice(visible, target))
        target = merge_frames(target, src).cache()
    assert rows(target) == rows(full)


def test_overwrite_merge_lets_source_win(spark):
    t = silver_quotes(_bronze(spark, [event(ticker="A", event_id="old", ingestion_ts="2024-01-02T13:30:00.000Z")]))
    s = silver_quotes(_bronze(spark, [event(ticker="A", event_id="new", ingestion_ts="2024-01-02T13:45:00.000Z"),
                                      event(ticker="B", event_id="b")]))
    first = {r.ticker: r.event_id for r in merge_frames(t, s).collect()}
    over = {r.ticker: r.event_id for r in merge_frames(t, s, on_match="overwrite").collect()}
    assert first == {"A": "old", "B": "b"} and over == {"A": "new", "B": "b"}


def test_incremental_slice_epoch_when_target_empty(spark):
    b = _bronze(spark, [event(ticker="A"), event(ticker="B")])
    empty = silver_quotes(b).limit(0)
    assert incremental_slice(b, empty).count() == 2


def test_slice_prunes_bronze_partitions(spark, tmp):
    b = _random_log(spark)
    b.write.partitionBy("ingestion_date").parquet(tmp + "/bronze")
    stored = spark.read.parquet(tmp + "/bronze")
    plan = incremental_slice(stored, silver_quotes(stored))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_align_appends_new_columns(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(2, "b", 3.5)], "k int, v string, extra double")
    out = align(t, s)
    assert out.columns == ["k", "v", "extra"]
    assert rows(out) == [(1, "a", None), (2, "b", 3.5)]
