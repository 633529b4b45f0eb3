
from pyspark.sql import functions as F

from candlewick.operators.silver import silver_quotes
from candlewick.sources.events_feed import kafka_records
from candlewick.sources.kafka import quote_stream, to_bronze
from candlewick.streaming.bronze_stream import ProgressLog, await_or_raise, progress_frame, start_bronze, \
    start_silver_upsert
from candlewick.functions.timeutil import utc_instant
from tests.helpers import event, kafka_df, rows

EVENTS = "/root/testdata/sf0.001/events.parquet"


def _records(spark):
    return kafka_records(spark.read.parquet(EVENTS), "type").withColumn("timestamp", utc_instant("timestamp"))


def test_stream_restart_is_exactly_once_and_equals_batch(spark, tmp):
    rec = _records(spark)
    src, out, chk = tmp + "/src", tmp + "/bronze", tmp + "/chk"
    half = rec.filter(F.col("offset") % 2 == 0)
    other = rec.filter(F.col("offset") % 2 == 1)
    half.repartition(3).write.parquet(src)
    listener = ProgressLog(tmp + "/progress", keep=1)
    spark.streams.addListener(listener)
    try:
        q1 = start_bronze(quote_stream(spark, "parquet", src, maxFilesPerTrigger=1), out, chk, available_now=True)
        await_or_raise(q1)
        n1 = spark.read.parquet(out).count()
        other.repartition(2).write.mode("append").parquet(src)        # new files arrive while stopped
        q2 = start_bronze(quote_stream(spark, "parquet", src, maxFilesPerTrigger=1), out, chk, available_now=True)
        await_or_raise(q2)
        for q in (q1, q2):
            listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    streamed = spark.read.parquet(out).drop("processing_ts")
    batch = to_bronze(rec).drop("processing_ts")
    assert n1 == half.count()
    assert streamed.count() == batch.count()                         # nothing re-appended after restart
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0
    import pytest

    from candlewick.sources.tables import compact
    with pytest.raises(ValueError, match="streaming file-sink"):
        compact(spark, out, "ingestion_date")
    pf = progress_frame(spark, tmp + "/progress").collect()
    assert sum(r.rows for r in pf) == rec.count() and len(pf) == len({(r.query, r.batch_id) for r in pf}) >= 5
    assert len(listener.batches) == 1                                # the log, not the buffer, holds the run
    assert listener.totals(spark).first().rows == rec.count()


def test_foreach_batch_upsert_equals_batch_silver(spark, tmp):
    rec = _records(spark)
    src, silver_p, chk = tmp + "/src", tmp + "/silver", tmp + "/chk"
    rec.repartition(4).write.parquet(src)
    stream = to_bronze(quote_stream(spark, "parquet", src, maxFilesPerTrigger=1))
    await_or_raise(start_silver_upsert(stream, silver_p, chk, available_now=True))
    got = spark.read.parquet(silver_p).drop("processing_ts")
    exp = silver_quotes(to_bronze(rec)).drop("processing_ts")
    assert rows(got.select(*exp.columns)) == rows(exp)


def test_a_batch_of_one_file_is_decoded_by_many_tasks(spark, tmp):
    import glob
    src, out = f"{tmp}/src", f"{tmp}/bronze"
    records = kafka_df(spark, [event(event_id=str(i)) for i in range(400)])
    records.coalesce(1).write.parquet(src)
    await_or_raise(start_bronze(quote_stream(spark, "parquet", src), out, f"{tmp}/chk", available_now=True))
    assert spark.read.parquet(out).select("event_id").distinct().count() == 400
    assert len(glob.glob(f"{out}/*/*.parquet")) == spark.sparkContext.defaultParallelism
