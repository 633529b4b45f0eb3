"""Scaling check: densified copies of ``events`` (each copy 1 ms after the
original, so every instrument-day gets proportionally hotter) and timings of
the heavy operators at each factor.

usage: python scripts/scale_check.py [sf_dir] [factor ...]
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from candlewick.config import build_session, scratch_path  # noqa: E402
from candlewick.plans import catalog as K  # noqa: E402


def densified(spark, src: str, factor: int, out: str) -> None:
    ev = spark.read.parquet(f"{src}/events.parquet")
    n = ev.agg(F.max("event_id")).first()[0] + 1
    big = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("copy")).select(
        (F.col("event_id") + F.col("copy") * n).alias("event_id"),
        F.expr("ts + make_dt_interval(0, 0, 0, copy * 0.001)").alias("ts"),
        "user_id", "event_type", "value", "props")
    big.write.parquet(f"{out}/events.parquet")
    for t in ("customer", "nation"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")


def main() -> None:
    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    factors = [int(x) for x in sys.argv[2:]] or [1, 4, 16]
    spark = build_session("candlewick-scale", master="local[8]", shuffle_partitions=16,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    out = {}
    for f in factors:
        d = scratch_path(spark, f"scale{f}")
        densified(spark, src, f, d)
        rows = spark.read.parquet(f"{d}/events.parquet").count()
        res = {"events": rows}
        for name in ("silver_dedup", "candles_full", "intraday_running_state", "snapshot_full"):
            t0 = time.perf_counter()
            K.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            res[name] = round(time.perf_counter() - t0, 2)
        out[f] = res
        print(json.dumps({"factor": f, **res}), flush=True)


if __name__ == "__main__":
    main()
