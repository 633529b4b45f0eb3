"""The batch build: silver -> gold -> summary, with layer gates and alerts
(Q11, Q12, A08)."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import GOLD_LOOKBACK_DAYS, MARKET_TZ, REPROCESS_MINUTES, RUN_FAILED, RUN_OK, as_of_col
from candlewick.operators.candles import gold_candles
from candlewick.operators.common import lookback_filter
from candlewick.operators.incremental import log_changes, pending_changes, refresh_candles, refresh_day_states, \
    settle, snapshot_from_states, touched_buckets
from candlewick.operators.sectors import sector_performance
from candlewick.operators.silver import high_water_value, incremental_slice, silver_quotes
from candlewick.operators.snapshot import ticker_snapshot
from candlewick.plans.checks import Check, Watch, evaluate, gold_suite, seed_suite, silver_suite, status_of
from candlewick.schemas import CANDLE_COLUMNS, LAYER_COUNTS
from candlewick.sources.oplog import append_json, read_run_results, results_files
from candlewick.sources.tables import is_absent, materialize, merge_silver, stored, touched_part, write_seed, write_table


NOT_RUN = "not run"


def results_frame(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(unique_id, layer, status) rows for nodes that are not checks (models, seeds)."""
    return spark.createDataFrame(list(rows), "unique_id string, layer string, status string")


def run_summary(results: DataFrame) -> DataFrame:
    """Per-layer and total counts by node kind x status, plus an overall status.

    Tests with status ``error`` count as failed and as errors; the run is ok
    only without failed tests and errors. The total is the ROLLUP row.
    """
    uid, st = F.col("unique_id"), F.col("status")
    is_test = uid.startswith("test.")
    agg = results.rollup("layer").agg(
        F.count_if(uid.startswith("model.")).alias("models"),
        F.count_if(uid.startswith("seed.")).alias("seeds"),
        F.count_if(is_test & (st == "pass")).alias("tests_pass"),
        F.count_if(is_test & st.isin("fail", "error")).alias("tests_fail"),
        F.count_if(is_test & (st == "warn")).alias("tests_warn"),
        F.count_if(st == "error").alias("errors"),
    )
    return agg.select(
        F.coalesce(F.col("layer"), F.lit("total")).alias("layer"),
        "models", "seeds", "tests_pass", "tests_fail", "tests_warn", "errors",
        F.when((F.col("tests_fail") == 0) & (F.col("errors") == 0), RUN_OK).otherwise(RUN_FAILED).alias("status"))


def artifact_summary(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """The run's summary from what its layers left behind: per layer and in total
    the counts of :func:`run_summary`, the summed ``elapsed_time`` of the results
    files, and whether the layer ran. A layer without results did not run; it has
    zero counts and makes the run neither ok nor failed by itself."""
    found = {layer: path for layer, path in paths.items() if _has_results(spark, path)}
    nodes = [read_run_results(spark, path, layer).select("unique_id", "layer", "status") for layer, path in found.items()]
    times = [results_files(spark, path).select(F.lit(layer).alias("layer"), F.round("elapsed_time", 2).alias("t"))
             for layer, path in found.items()]
    layers = spark.createDataFrame([(layer, layer in found) for layer in paths], "layer string, ran boolean")
    counts = run_summary(reduce(DataFrame.unionByName, nodes, results_frame(spark, [])))
    elapsed = reduce(DataFrame.unionByName, times, spark.createDataFrame([], "layer string, t double")).rollup(
        "layer").agg(F.round(F.sum("t"), 2).alias("elapsed_seconds")).withColumn("layer", F.coalesce("layer", F.lit("total")))
    every = layers.unionByName(layers.agg(F.lit("total").alias("layer"), F.bool_and("ran").alias("ran")))
    out = every.join(counts, "layer", "left").join(elapsed, "layer", "left")
    return out.select("layer", "ran", *(F.coalesce(f.name, F.lit(0).cast("long")).alias(f.name) for f in LAYER_COUNTS.fields),
                      F.coalesce("elapsed_seconds", F.lit(0.0)).alias("elapsed_seconds"),
                      F.when(F.col("ran") | (F.col("layer") == "total"), F.coalesce("status", F.lit(RUN_OK)))
                      .otherwise(NOT_RUN).alias("status"))


def _has_results(spark: SparkSession, path: str) -> bool:
    try:
        return not results_files(spark, path).isEmpty()
    except AnalysisException as e:
        if is_absent(e):
            return False
        raise


def alerts_from(results: DataFrame, run_id: str, dag_id: str = "batch_lakehouse",
                detected_at: str | None = None) -> DataFrame:
    """Failed nodes -> alert records (severity error), ready for ``append_json``."""
    at = F.lit(detected_at) if detected_at is not None else F.date_format(
        F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return results.filter(F.col("status").isin("fail", "error")).select(
        F.lit("error").alias("severity"), at.alias("detected_at"),
        F.lit(dag_id).alias("dag_id"), F.col("layer").alias("task_id"), F.lit(run_id).alias("run_id"),
        F.lit(1).alias("try_number"),
        F.concat(F.col("unique_id"), F.lit(" "), F.col("status")).alias("exception"),
        F.lit(None).cast("string").alias("log_url"))


def run_record(results: DataFrame, run_id: str, logical_date: str, finished_at: str, elapsed_seconds: float) -> DataFrame:
    """The one-row record of a run: totals, a count struct per layer, status."""
    summary = run_summary(results)
    counts = [f.name for f in LAYER_COUNTS.fields]
    layers = summary.filter(F.col("layer") != "total").groupBy().agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("layer", F.struct(*counts).alias("counts"))))).alias("layers"))
    return summary.filter(F.col("layer") == "total").crossJoin(layers).select(   # one row each
        F.lit(run_id).alias("run_id"), F.lit(logical_date).alias("logical_date"), F.lit(finished_at).alias("finished_at"),
        *counts, F.lit(float(elapsed_seconds)).alias("elapsed_seconds"), "status", "layers")


class _Run:
    """Collects one (unique_id, layer, status) row per node of a run."""

    def __init__(self, spark: SparkSession, as_of) -> None:
        self.spark, self.as_of = spark, as_of
        self.rows: list[tuple[str, str, str]] = []
        self.errors: dict[str, str] = {}

    def model(self, uid: str, layer: str, work: Callable[[], None]) -> bool:
        try:
            work()
        except Exception as e:  # noqa: BLE001 - any failure is the node's result
            self.errors[uid] = str(e)
            self.rows.append((uid, layer, "error"))
            return False
        self.rows.append((uid, layer, "success"))
        return True

    def checks(self, suite: Sequence[Check], tables: Mapping[str, DataFrame], seen: Mapping[str, int]) -> bool:
        """Evaluate a suite (one small row per check comes back). Checks that were
        ``seen`` while their table was written are not run again. A suite that
        cannot run has status error throughout."""
        try:
            found = [(c.unique_id, c.layer, status_of(seen[c.unique_id], c.severity)) for c in suite if c.unique_id in seen]
            left = [c for c in suite if c.unique_id not in seen]
            found += [(r.unique_id, r.layer, r.status) for r in
                      evaluate(left, tables, self.as_of).select("unique_id", "layer", "status").collect()] if left else []
        except Exception as e:  # noqa: BLE001
            found = [(c.unique_id, c.layer, "error") for c in suite]
            self.errors.update((c.unique_id, str(e)) for c in suite)
        self.rows += found
        return all(status not in ("fail", "error") for _, _, status in found)

    def frame(self) -> DataFrame:
        return results_frame(self.spark, self.rows)


def build(spark: SparkSession, bronze: DataFrame, dim: DataFrame, root: str, as_of=None, tz: str = MARKET_TZ,
          lookback_days: int | None = GOLD_LOOKBACK_DAYS, bucket: str = "1 minute", digits: int = 4,
          sma_digits: int | None = None, gate: bool = True, dim_parent: DataFrame | None = None,
          incremental: bool = False, reprocess_minutes: int = REPROCESS_MINUTES, by_hour: bool = False,
          check_all_days: bool = False, run_id: str | None = None, logical_date: str = ""):
    """The batch build: seed (+checks) -> silver (+checks) -> gold (+checks).

    Every layer is written as a table under ``root`` and the next layer reads it
    back, so nothing is recomputed. Row-level checks are counted while their table
    is written; only checks on sets of rows (keys, relationships) scan it again,
    and only their columns. With ``gate`` a layer whose checks fail stops the build
    before the next one starts. A model or suite that raises has status
    ``error``; it stops the build likewise, and the run is still recorded.

    With ``incremental`` and an existing silver table, only bronze at or after
    the stored high-water mark is read (partition-pruned) and merged first-wins
    into silver; the bronze checks run on that slice and the silver checks on
    the days it touches (``check_all_days``: on the whole table). Gold follows the
    merge: only candles that the slice changes, directly or through their
    metrics' look-back, are recomputed (the tables' parameters must not change
    between incremental runs). ``by_hour`` partitions silver and candles by day
    and hour.

    With ``run_id`` the run's record and its alerts are appended under
    ``root/logs`` whatever happened. Returns ``(tables, results)``; results hold
    one row per model, seed and check (unique_id, layer, status).
    """
    began = time.monotonic()
    root = root.rstrip("/")
    p = {n: f"{root}/{n}" for n in ("dim_tickers", "silver", "candles", "day_states", "snapshot", "sectors",
                                     "high_water", "changes")}
    tables = {"bronze": bronze}
    parent = {"dim_tickers": dim_parent} if dim_parent is not None else {}
    run = _Run(spark, as_of)

    watched: list[Watch] = []

    def watch(name: str, suite: Sequence[Check]) -> Callable[[DataFrame], DataFrame]:
        watched.append(Watch(suite, name, as_of))
        return watched[-1].attach

    def saved(name: str, work: Callable[[], None]) -> Callable[[], None]:
        def go() -> None:
            work()
            tables[name] = stored(spark, p[name])
        return go

    def silver() -> None:
        current = stored(spark, p["silver"]) if incremental else None
        if current is not None:
            hwm = _stored_mark(spark, p["high_water"], reprocess_minutes)
            hwm = high_water_value(current, reprocess_minutes) if hwm is None else hwm
            tables["bronze"] = incremental_slice(bronze, None, reprocess_minutes, tz, hwm=hwm)
            new = materialize(silver_quotes(tables["bronze"], tz, digits), "silver_slice")
            log_changes(spark, touched_buckets(new, bucket), p["changes"])
            # The merge rewrites the touched days, the rows that the checks are about.
            whole_days = not by_hour and not check_all_days
            merge_silver(spark, new, p["silver"], by_hour, watch("silver", silver_suite()) if whole_days else None)
        else:
            new = silver_quotes(bronze, tz, digits)
            if by_hour:
                write_table(new.withColumn("quote_hour", F.hour("quote_ts")), p["silver"], ["trading_date", "quote_hour"],
                            watch=watch("silver", silver_suite()))
            else:
                write_table(new, p["silver"], ["trading_date"], watch=watch("silver", silver_suite()))
            new = stored(spark, p["silver"])
        new.agg(F.max("ingestion_ts").alias("mark")).filter("mark IS NOT NULL").write.mode("append").parquet(p["high_water"])
        whole = tables["silver"] = stored(spark, p["silver"])
        checked["silver"] = whole if current is None or check_all_days else touched_part(whole, new, ["trading_date"])
        changed["keys"], changed["last"] = pending_changes(spark, p["changes"])
        if current is None:   # everything changed
            changed["keys"] = None

    def candles() -> None:
        """Follow the merged keys; without any, rebuild."""
        if changed["keys"] is None:
            full = gold_candles(tables["silver"], as_of, tz, lookback_days, bucket, digits, sma_digits)
            if by_hour:
                write_table(full.withColumn("candle_hour", F.hour("window_start")), p["candles"],
                            ["trading_date", "candle_hour"], watch=watch("candles", gold_suite()))
            else:
                write_table(full, p["candles"], ["trading_date"], watch=watch("candles", gold_suite()))
        else:
            refresh_candles(spark, tables["silver"], changed["keys"], p["candles"], as_of, tz, lookback_days, bucket,
                            digits, sma_digits, by_hour)
        tables["candles"] = lookback_filter(stored(spark, p["candles"]).select(*CANDLE_COLUMNS), as_of_col(as_of), tz,
                                            lookback_days)

    def snapshot() -> DataFrame:
        if not incremental and stored(spark, p["day_states"]) is None:
            return ticker_snapshot(tables["silver"], tables["candles"], tables["dim_tickers"], as_of, tz, lookback_days,
                                   digits)
        refresh_day_states(spark, tables["silver"], changed["keys"], p["day_states"], as_of, tz, lookback_days)
        return snapshot_from_states(stored(spark, p["day_states"]), tables["candles"], tables["dim_tickers"], as_of, tz,
                                    lookback_days, digits)

    def sectors() -> None:
        write_table(sector_performance(tables["snapshot"], digits), p["sectors"], watch=watch("sectors", gold_suite()))
        settle(spark, p["changes"], changed["last"])

    changed: dict = {}
    checked: dict[str, DataFrame] = {}
    layers: list[tuple[str, list[tuple[str, Callable[[], None]]], list[Check], Callable[[], dict[str, DataFrame]]]] = [
        ("seed", [("seed.dim_tickers", saved("dim_tickers", lambda: write_seed(dim, p["dim_tickers"])))],
         seed_suite(), lambda: {**tables, **parent}),
        ("silver", [("model.silver_quotes", silver)], silver_suite(), lambda: {**tables, **checked, **parent}),
        ("gold", [
            ("model.gold_intraday_candles", candles),
            ("model.gold_ticker_snapshot", saved("snapshot", lambda: write_table(
                snapshot(), p["snapshot"], watch=watch("snapshot", gold_suite())))),
            ("model.gold_sector_performance", saved("sectors", sectors)),
        ], gold_suite(), lambda: {**tables, **parent}),
    ]
    for layer, models, suite, frames in layers:
        if not all(run.model(uid, layer, work) for uid, work in models):
            break
        seen = {uid: n for w in watched for uid, n in w.failures().items()}
        if not run.checks(suite, frames(), seen) and gate:
            break
    results = run.frame()
    if run_id is not None:
        finished = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S+00:00")
        append_json(run_record(results, run_id, logical_date, finished, time.monotonic() - began), f"{root}/logs/runs")
        append_json(alerts_from(results, run_id, detected_at=finished), f"{root}/logs/alerts")
    return tables, results


def _stored_mark(spark: SparkSession, path: str, reprocess_minutes: int):
    """The newest ingestion time merged so far, lowered, as a literal; None when unknown."""
    marks = stored(spark, path)
    value = None if marks is None else marks.agg(
        (F.max("mark") - F.make_dt_interval(mins=F.lit(reprocess_minutes))).alias("h")).first()["h"]
    return None if value is None else F.lit(value).cast("timestamp_ntz")
