"""Small shared building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], hashed: bool = False) -> DataFrame:
    """First row per key under ``order``.

    Planned as ``WindowGroupLimit`` (partial, before the shuffle) + final
    limit after it, so a hot key is cut down to one row per map task before
    anything moves: skew does not concentrate rows in one reducer.

    ``hashed`` puts a 64-bit hash of the key before it, for keys that share
    their first column with many others: the sorts then compare one long and look
    at the key itself only where the hashes are equal. The rows are the same; the
    result is not partitioned by ``keys`` alone.
    """
    rn, kh = "__rn", "__key_hash"
    if hashed:
        df = df.withColumn(kh, F.xxhash64(*keys))
    w = Window.partitionBy(*([kh] if hashed else []), *keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn, kh)


def lookback_filter(df: DataFrame, as_of: Column, tz: str, days: int | None,
                    date_col: str = "trading_date") -> DataFrame:
    """``date_col >= market_date(as_of) - days`` (includes today and the N days before).

    On a table partitioned by ``date_col`` this is a partition filter.
    """
    if days is None:
        return df
    from candlewick.functions.timeutil import market_date
    return df.filter(F.col(date_col) >= F.date_sub(market_date(as_of, tz), days))
