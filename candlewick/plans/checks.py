"""The declarative check suite of each layer and its evaluation.

A check is (unique_id, layer, kind, target table, parameters). Running a
suite builds one DataFrame with one row per check: the offending-row count
and a status (pass / fail, or warn for warn-severity checks).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from candlewick.config import (
    ACCEPTED_SOURCES, CHANGE_PCT_LIMIT, FUTURE_TOLERANCE_MINUTES, PRICE_MAX, PRICE_MIN, VOLUME_MAX, as_of_col,
)
from candlewick.operators import quality as q


@dataclass(frozen=True)
class Check:
    unique_id: str
    layer: str
    kind: str
    table: str
    column: str | None = None
    params: Mapping = field(default_factory=dict)
    severity: str = "error"


def offending(check: Check, tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """The offending rows of one check."""
    df = tables[check.table]
    p = check.params
    kinds: dict[str, Callable[[], DataFrame]] = {
        "not_null": lambda: q.not_null(df, check.column),
        "unique": lambda: q.unique(df, check.column),
        "accepted_values": lambda: q.accepted_values(df, check.column, p["values"]),
        "relationships": lambda: q.relationships(df, check.column, tables[p["to"]], p["field"]),
        "between": lambda: q.between(df, check.column, p["min"], p["max"]),
        "unique_combination": lambda: q.unique_combination(df, p["columns"]),
        "fresh": lambda: q.assert_fresh(df, check.column, p.get("minutes", 20), as_of),
        "ohlc": lambda: q.assert_ohlc(df),
        "no_future": lambda: q.assert_no_future(df, check.column, as_of),
    }
    return kinds[check.kind]()


ROW_LEVEL = {"not_null", "accepted_values", "between", "no_future", "ohlc", "fresh"}


def _violation(check: Check, as_of) -> Column:
    """Per-row violation predicate of a row-level check (fresh: see below)."""
    c, p = check.column, check.params
    at = as_of_col(as_of)
    if check.kind == "not_null":
        return F.col(c).isNull()
    if check.kind == "accepted_values":
        return F.col(c).isNotNull() & ~F.col(c).isin(list(p["values"]))
    if check.kind == "between":
        return F.col(c).isNotNull() & ((F.col(c) < p["min"]) | (F.col(c) > p["max"]))
    if check.kind == "no_future":
        return F.col(c) > at + F.make_dt_interval(mins=F.lit(FUTURE_TOLERANCE_MINUTES))
    if check.kind == "ohlc":
        o, h, lo, cl = (F.col(x) for x in ("open_price", "high_price", "low_price", "close_price"))
        return (h < lo) | (h < F.greatest(o, cl)) | (lo > F.least(o, cl))
    raise ValueError(check.kind)


def _fused(table_checks: Sequence[Check], df: DataFrame, as_of) -> DataFrame:
    """All row-level checks of one table in a single aggregate pass.

    Failures count offending rows (for freshness: 1 when stale or empty);
    the status is the same as evaluating each check on its own.
    """
    at = as_of_col(as_of)
    aggs = []
    for i, c in enumerate(table_checks):
        if c.kind == "fresh":
            aggs.append(F.max(c.column).alias(f"v{i}"))
        else:
            aggs.append(F.count_if(_violation(c, as_of)).alias(f"v{i}"))
    one = df.agg(*aggs)
    items = []
    for i, c in enumerate(table_checks):
        v = F.col(f"v{i}")
        if c.kind == "fresh":
            stale = v.isNull() | (v < at - F.make_dt_interval(mins=F.lit(c.params.get("minutes", 20))))
            v = F.when(stale, F.lit(1)).otherwise(F.lit(0)).cast("long")
        items.append(F.struct(F.lit(c.unique_id).alias("unique_id"), F.lit(c.layer).alias("layer"),
                              v.cast("long").alias("failures"), F.lit(c.severity).alias("severity")))
    return one.select(F.inline(F.array(*items)))


class Watch:
    """The row-level checks of one table, counted in the pass that writes it.

    ``attach`` is applied to the rows just before they are written, in the stage
    that writes them, so a lost executor's earlier stages do not count twice;
    ``failures`` gives the counts once the write has succeeded. Freshness looks at
    a table's newest row and stays with :func:`evaluate`.
    """

    def __init__(self, suite: Sequence[Check], table: str, as_of=None) -> None:
        self.checks = [c for c in suite if c.table == table and c.kind in ROW_LEVEL - {"fresh"}]
        self.as_of = as_of
        self.seen: Observation | None = None

    def attach(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        self.seen = Observation()
        return df.observe(self.seen, *(F.count_if(_violation(c, self.as_of)).alias(c.unique_id) for c in self.checks))

    def failures(self) -> dict[str, int]:
        """unique_id -> offending rows; empty when nothing was written."""
        return {} if self.seen is None else {c.unique_id: int(self.seen.get[c.unique_id]) for c in self.checks}


def status_of(failures: int, severity: str) -> str:
    return "pass" if failures == 0 else "warn" if severity == "warn" else "fail"


def evaluate(checks: Sequence[Check], tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """One row per check: unique_id, layer, failures, status.

    Row-level checks of a table are fused into one scan; set-level checks
    (uniqueness, key combinations, relationships) each run their own partial
    aggregate or anti-join. All of it is a single job.
    """
    parts = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ROW_LEVEL:
            by_table.setdefault(c.table, []).append(c)
        else:
            if c.kind == "relationships":
                lost = q.orphans(tables[c.table], c.column, tables[c.params["to"]], c.params["field"])
                n = lost.agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("long").alias("failures"))
            else:
                n = offending(c, tables, as_of).agg(F.count(F.lit(1)).cast("long").alias("failures"))
            parts.append(n.select(F.lit(c.unique_id).alias("unique_id"), F.lit(c.layer).alias("layer"),
                                  "failures", F.lit(c.severity).alias("severity")))
    for t, cs in by_table.items():
        parts.append(_fused(cs, tables[t], as_of))
    out = reduce(DataFrame.unionByName, parts)
    return out.select("unique_id", "layer", "failures",
                      F.when(F.col("failures") == 0, "pass")
                      .when(F.col("severity") == "warn", "warn").otherwise("fail").alias("status"))


def _t(name, layer, kind, table, column=None, **params) -> Check:
    return Check(f"test.{layer}.{name}", layer, kind, table, column, params)


def silver_suite(dim_table: str = "dim_tickers") -> list[Check]:
    """The silver layer checks (13) plus the bronze source checks (7) and freshness."""
    src = list(ACCEPTED_SOURCES)
    return [
        _t("bronze_not_null_event_id", "silver", "not_null", "bronze", "event_id"),
        _t("bronze_not_null_ticker", "silver", "not_null", "bronze", "ticker"),
        _t("bronze_not_null_price", "silver", "not_null", "bronze", "price"),
        _t("bronze_between_price", "silver", "between", "bronze", "price", min=PRICE_MIN, max=PRICE_MAX),
        _t("bronze_not_null_ingestion_ts", "silver", "not_null", "bronze", "ingestion_ts"),
        _t("bronze_not_null_source", "silver", "not_null", "bronze", "source"),
        _t("bronze_accepted_source", "silver", "accepted_values", "bronze", "source", values=src),
        _t("bronze_fresh", "silver", "fresh", "bronze", "ingestion_ts", minutes=20),
        _t("silver_unique_ticker_quote_ts", "silver", "unique_combination", "silver",
           columns=["ticker", "quote_ts"]),
        _t("silver_not_null_event_id", "silver", "not_null", "silver", "event_id"),
        _t("silver_not_null_ticker", "silver", "not_null", "silver", "ticker"),
        _t("silver_relationships_ticker", "silver", "relationships", "silver", "ticker", to=dim_table,
           field="ticker"),
        _t("silver_not_null_quote_ts", "silver", "not_null", "silver", "quote_ts"),
        _t("silver_not_null_ingestion_ts", "silver", "not_null", "silver", "ingestion_ts"),
        _t("silver_not_null_price", "silver", "not_null", "silver", "price"),
        _t("silver_between_price", "silver", "between", "silver", "price", min=PRICE_MIN, max=PRICE_MAX),
        _t("silver_between_change_pct", "silver", "between", "silver", "change_pct",
           min=-CHANGE_PCT_LIMIT, max=CHANGE_PCT_LIMIT),
        _t("silver_between_volume", "silver", "between", "silver", "volume", min=0, max=VOLUME_MAX),
        _t("silver_not_null_source", "silver", "not_null", "silver", "source"),
        _t("silver_accepted_source", "silver", "accepted_values", "silver", "source", values=src),
        _t("silver_not_null_trading_date", "silver", "not_null", "silver", "trading_date"),
        _t("silver_no_future_quotes", "silver", "no_future", "silver", "quote_ts"),
    ]


def seed_suite(dim_table: str = "dim_tickers") -> list[Check]:
    return [
        _t("dim_not_null_ticker", "seed", "not_null", dim_table, "ticker"),
        _t("dim_unique_ticker", "seed", "unique", dim_table, "ticker"),
        _t("dim_not_null_company_name", "seed", "not_null", dim_table, "company_name"),
        _t("dim_not_null_sector", "seed", "not_null", dim_table, "sector"),
    ]


def gold_suite(dim_table: str = "dim_tickers") -> list[Check]:
    src = list(ACCEPTED_SOURCES)
    c = "candles"
    s = "snapshot"
    return [
        _t("candles_unique_ticker_window", "gold", "unique_combination", c, columns=["ticker", "window_start"]),
        *[_t(f"candles_not_null_{col}", "gold", "not_null", c, col)
          for col in ("ticker", "window_start", "open_price", "high_price", "low_price", "close_price",
                      "n_ticks", "trading_date")],
        _t("candles_relationships_ticker", "gold", "relationships", c, "ticker", to=dim_table, field="ticker"),
        _t("candles_between_open", "gold", "between", c, "open_price", min=PRICE_MIN, max=PRICE_MAX),
        _t("candles_between_close", "gold", "between", c, "close_price", min=PRICE_MIN, max=PRICE_MAX),
        _t("candles_between_volume_delta", "gold", "between", c, "volume_delta", min=0, max=VOLUME_MAX),
        _t("candles_accepted_source", "gold", "accepted_values", c, "source", values=src),
        _t("candles_ohlc_coherent", "gold", "ohlc", c),
        *[_t(f"snapshot_not_null_{col}", "gold", "not_null", s, col)
          for col in ("ticker", "company_name", "sector", "last_price", "source")],
        _t("snapshot_unique_ticker", "gold", "unique", s, "ticker"),
        _t("snapshot_relationships_ticker", "gold", "relationships", s, "ticker", to=dim_table, field="ticker"),
        _t("snapshot_between_last_price", "gold", "between", s, "last_price", min=PRICE_MIN, max=PRICE_MAX),
        _t("snapshot_between_change_pct", "gold", "between", s, "change_pct",
           min=-CHANGE_PCT_LIMIT, max=CHANGE_PCT_LIMIT),
        _t("snapshot_between_range_position", "gold", "between", s, "day_range_position_pct", min=0, max=100),
        _t("snapshot_accepted_source", "gold", "accepted_values", s, "source", values=src),
        _t("sectors_not_null_sector", "gold", "not_null", "sectors", "sector"),
        _t("sectors_unique_sector", "gold", "unique", "sectors", "sector"),
        _t("sectors_not_null_n_tickers", "gold", "not_null", "sectors", "n_tickers"),
        _t("sectors_between_avg_change_pct", "gold", "between", "sectors", "avg_change_pct",
           min=-CHANGE_PCT_LIMIT, max=CHANGE_PCT_LIMIT),
    ]
