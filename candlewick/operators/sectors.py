"""Gold sector performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.schemas import SECTOR_COLUMNS


def sector_performance(snapshot: DataFrame, digits: int = 4) -> DataFrame:
    """One row per sector over tickers with a sector and a change.

    Averages are unweighted. Ties for best / worst ticker go to the smallest
    ticker (deterministic, unlike a bare arg-max).
    """
    s = snapshot.filter(F.col("sector").isNotNull() & F.col("change_pct").isNotNull())
    return s.groupBy("sector").agg(
        F.count(F.lit(1)).alias("n_tickers"),
        F.round(F.avg("change_pct"), digits).alias("avg_change_pct"),
        F.round(F.max("change_pct"), digits).alias("best_change_pct"),
        F.round(F.min("change_pct"), digits).alias("worst_change_pct"),
        F.min_by("ticker", F.struct(-F.col("change_pct"), F.col("ticker"))).alias("best_ticker"),
        F.min_by("ticker", F.struct(F.col("change_pct"), F.col("ticker"))).alias("worst_ticker"),
        F.sum("volume_cumulative").alias("total_volume"),
        F.round(F.avg("volatility_pct_20"), digits).alias("avg_volatility_pct_20"),
        F.max("refreshed_at").alias("refreshed_at"),
    ).select(*SECTOR_COLUMNS)
