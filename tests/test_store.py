import pytest
import glob
import json
import os

from pyspark.sql import functions as F

from candlewick.schemas import ALERT_SCHEMA, DIM_SCHEMA
from candlewick.sources.kafka import empty_bronze
from candlewick.sources.oplog import append_json, read_run_results, tail_json
from candlewick.sources.tables import bootstrap_table, compact, load_dim, merge_into, read_table, register, \
    show_query, write_seed, write_table
from tests.helpers import rows, silver_df


def _files(path):
    return [f for f in glob.glob(path + "/**/*.parquet", recursive=True)]


def test_bootstrap_is_idempotent(spark, tmp):
    p = tmp + "/bronze"
    e = empty_bronze(spark)
    bootstrap_table(e, p, ["ingestion_date"], table="lake_boot.quotes")
    bootstrap_table(e, p, ["ingestion_date"], table="lake_boot.quotes")
    df = read_table(spark, p, schema=e.schema)
    assert df.count() == 0 and df.schema.simpleString() == e.schema.simpleString()
    t = spark.table("lake_boot.quotes")
    assert t.count() == 0 and set(t.columns) == set(e.columns)


def test_seed_replaces_and_loads_typed(spark, tmp):
    csv = tmp + "/seed.csv"
    with open(csv, "w") as f:
        f.write("ticker,company_name,sector,b3_index\nPETR4,Petrobras,Oil,IBOV\n0001,Zero,Misc,\n")
    d = load_dim(spark, csv)
    assert d.schema == DIM_SCHEMA
    assert rows(d) == [("0001", "Zero", "Misc", None), ("PETR4", "Petrobras", "Oil", "IBOV")]
    write_seed(d, tmp + "/dim")
    write_seed(d, tmp + "/dim")
    assert spark.read.parquet(tmp + "/dim").count() == 2


def test_merge_into_touches_only_source_partitions(spark, tmp):
    p = tmp + "/silver"
    day1 = silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 13:00:00", price=1.0, event_id="a1")])
    day2 = silver_df(spark, [dict(ticker="A", quote_ts="2024-01-03 13:00:00", price=2.0, event_id="a2")])
    merge_into(spark, day1.unionByName(day2), p)
    before = {f: os.path.getmtime(f) for f in _files(p) if "2024-01-02" in f}
    late = silver_df(spark, [dict(ticker="A", quote_ts="2024-01-03 13:00:00", price=9.0, event_id="dup",
                                  ingestion_ts="2024-01-03 13:10:00", kafka_offset=99),
                             dict(ticker="B", quote_ts="2024-01-03 13:00:00", price=3.0, event_id="b")])
    merge_into(spark, late, p)
    after = {f: os.path.getmtime(f) for f in _files(p) if "2024-01-02" in f}
    assert before == after                                   # untouched partition kept its files
    got = {(r.ticker, str(r.trading_date)): r.event_id for r in spark.read.parquet(p).collect()}
    assert got == {("A", "2024-01-02"): "a1", ("A", "2024-01-03"): "a2", ("B", "2024-01-03"): "b"}


def test_compaction_preserves_rows(spark, tmp):
    p = tmp + "/t"
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("d"), "id")
    df.repartition(20).write.partitionBy("d").parquet(p)
    n_before = len(_files(p))
    compact(spark, p, "d")
    after = spark.read.parquet(p)
    assert len(_files(p)) < n_before
    assert after.exceptAll(df.select("id", "d")).count() == 0 and after.count() == 2000


def test_write_table_and_pruned_read(spark, tmp):
    p = tmp + "/bronze"
    b = silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 13:00:00", price=1.0),
                          dict(ticker="B", quote_ts="2024-01-05 13:00:00", price=2.0)]).withColumnRenamed(
        "trading_date", "ingestion_date")
    write_table(b, p, ["ingestion_date"])
    r = read_table(spark, p, columns=["ticker", "price"], since="2024-01-04")
    assert rows(r) == [("B", 2.0)]
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and "ReadSchema: struct<ticker:string,price:double>" in plan
    missing = read_table(spark, tmp + "/nope", schema=DIM_SCHEMA)
    assert missing.count() == 0 and missing.schema == DIM_SCHEMA


def test_register_and_show_query(spark, tmp):
    p = tmp + "/reg"
    spark.range(120).write.parquet(p)
    register(spark, "lake_test", "numbers", p)
    register(spark, "lake_test", "numbers", p)
    top, n = show_query(spark, "SELECT * FROM lake_test.numbers")
    assert n.first().total_rows == 120 and top.count() == 50


def test_oplog_tail_skips_corrupt_lines(spark, tmp):
    p = tmp + "/alerts"
    recs = [dict(severity="error", detected_at=f"2024-01-0{i}T00:00:00+00:00", dag_id="d", task_id="t",
                 run_id=f"r{i}", try_number=1, exception="x", log_url=None) for i in range(1, 8)]
    append_json(spark.createDataFrame(recs[:4], ALERT_SCHEMA), p)
    append_json(spark.createDataFrame(recs[4:], ALERT_SCHEMA), p)
    with open(os.path.join(p, "corrupt.json"), "w") as f:
        f.write("{broken\n")
    got = [r.run_id for r in tail_json(spark, p, ALERT_SCHEMA, "detected_at", 5).collect()]
    assert got == ["r7", "r6", "r5", "r4", "r3"]
    assert tail_json(spark, tmp + "/none", ALERT_SCHEMA, "detected_at").count() == 0


def test_read_run_results(spark, tmp):
    p = tmp + "/run_results.json"
    with open(p, "w") as f:
        json.dump({"results": [{"unique_id": "model.silver_quotes", "status": "success", "execution_time": 1.5},
                               {"unique_id": "test.x", "status": "fail", "execution_time": 0.2}],
                   "elapsed_time": 3.25}, f, indent=2)
    r = read_run_results(spark, p, layer="silver")
    assert rows(r, "unique_id", "status", "layer") == [("model.silver_quotes", "success", "silver"),
                                                       ("test.x", "fail", "silver")]


def test_merge_into_hour_partitions(spark, tmp):
    p = tmp + "/silver_h"
    hour = lambda df: df.withColumn("quote_hour", F.hour("quote_ts"))
    a = hour(silver_df(spark, [dict(ticker="A", quote_ts="2024-01-02 13:00:00", price=1.0, event_id="a13"),
                               dict(ticker="A", quote_ts="2024-01-02 14:00:00", price=2.0, event_id="a14")]))
    merge_into(spark, a, p, partition_col=["trading_date", "quote_hour"])
    before = {f: os.path.getmtime(f) for f in _files(p) if "quote_hour=13" in f}
    late = hour(silver_df(spark, [dict(ticker="B", quote_ts="2024-01-02 14:30:00", price=3.0, event_id="b14")]))
    merge_into(spark, late, p, partition_col=["trading_date", "quote_hour"])
    assert {f: os.path.getmtime(f) for f in _files(p) if "quote_hour=13" in f} == before
    assert sorted(r.event_id for r in spark.read.parquet(p).collect()) == ["a13", "a14", "b14"]


def _silver_like(spark, rows_):
    return spark.createDataFrame(rows_, "ticker string, quote_ts timestamp_ntz, ingestion_ts timestamp_ntz, "
                                 "kafka_offset long, trading_date date, v double")


def test_merge_keeps_evolved_columns_and_prunes(spark, tmp):
    import datetime as dt

    from candlewick.sources.tables import compact, merge_into, stored
    p = tmp + "/evolving"
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    row = lambda t, d, h, o: (t, at(d, h), at(d, h), o, dt.date(2024, 1, d), float(o))
    merge_into(spark, _silver_like(spark, [row("a", 1, 1, 1)]), p)
    merge_into(spark, _silver_like(spark, [row("b", 2, 1, 2)]).withColumn("cap", F.lit(99.0)), p)
    merge_into(spark, _silver_like(spark, [row("c", 2, 2, 3)]), p)
    assert {r.ticker: r.cap for r in stored(spark, p).collect()} == {"a": None, "b": 99.0, "c": None}
    compact(spark, p, "trading_date")
    assert {r.ticker: r.cap for r in stored(spark, p).collect()} == {"a": None, "b": 99.0, "c": None}
    day = stored(spark, p).filter(F.col("trading_date").eqNullSafe(F.lit(dt.date(2024, 1, 2))))
    day.collect()
    assert "trading_date" in day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_unreadable_table_raises_and_keeps_its_files(spark, tmp):
    import datetime as dt
    import os

    from candlewick.sources.tables import merge_into
    p = tmp + "/broken"
    os.makedirs(p)
    with open(p + "/part-0.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file PAR1")
    now = dt.datetime(2024, 1, 1)
    with pytest.raises(Exception):
        merge_into(spark, _silver_like(spark, [("a", now, now, 1, now.date(), 1.0)]), p)
    assert os.listdir(p) == ["part-0.parquet"]


def test_full_refresh_leaves_no_old_partition(spark, tmp):
    p = tmp + "/full"
    for d in ("d1", "d2"):
        write_table(spark.createDataFrame([(1, d)], "v int, d string"), p, ["d"])
    assert [r.d for r in spark.read.parquet(p).collect()] == ["d2"]


def test_missing_checkpoint_folder_is_an_error():
    from candlewick.config import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_zone_free_times(spark):
    from candlewick.functions.timeutil import parse_utc
    d = spark.createDataFrame([("2024-01-01 13:00:00",), ("2024-01-01T13:00:00Z",), ("2024-01-01T13:00:00-03:00",),
                               ("2024-01-01T13:00:00.5+02",), ("2024-01-01",), ("x",), (None,)], "t string")
    seen = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            seen.append([str(r[0]) for r in d.select(parse_utc("t")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen[0] == seen[1] == ["2024-01-01 13:00:00", "2024-01-01 13:00:00", "2024-01-01 16:00:00",
                                  "2024-01-01 11:00:00.500000", "2024-01-01 00:00:00", "None", "None"]
