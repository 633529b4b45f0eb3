"""Quote arithmetic and classification as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.config import DIRECTION_DEAD_BAND, STALE_OK_BELOW_SECONDS, STALE_WARN_BELOW_SECONDS
from candlewick.functions.timeutil import epoch_seconds, market_is_open


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_double(col: Column | str) -> Column:
    """Unparsable -> NULL instead of an ANSI cast error."""
    return _c(col).try_cast("double")


def change_pct(price: Column | str, base: Column | str, digits: int = 4) -> Column:
    """Percent change against ``base``; NULL when base is NULL or 0."""
    return F.round((_c(price) / F.nullif(_c(base), F.lit(0.0)) - 1) * 100, digits)


def feed_delay_seconds(ingestion_ts: Column | str, quote_ts: Column | str) -> Column:
    """Source latency in whole seconds (may be negative); NULL beyond 68 years."""
    return (epoch_seconds(ingestion_ts) - epoch_seconds(quote_ts)).try_cast("int")


def expected_source(ts_utc: Column | str, tz: str) -> Column:
    """Provenance the feed should have: live API while the market is open."""
    return F.when(market_is_open(ts_utc, tz), F.lit("brapi")).otherwise(F.lit("simulated"))


def staleness_class(age_seconds: Column | str, ok_below: int = STALE_OK_BELOW_SECONDS,
                    warn_below: int = STALE_WARN_BELOW_SECONDS) -> Column:
    """NULL -> warn, < 90 s ok, < 20 min warn, otherwise crit."""
    age = _c(age_seconds)
    return (F.when(age.isNull(), "warn").when(age < ok_below, "ok")
            .when(age < warn_below, "warn").otherwise("crit"))


def direction(x: Column | str, dead_band: float = DIRECTION_DEAD_BAND) -> Column:
    """up / down / flat with a dead band around zero (NULL is flat)."""
    v = _c(x)
    return (F.when(v.isNull() | (F.abs(v) < dead_band), "flat")
            .when(v > 0, "up").otherwise("down"))


def candle_direction(open_price: Column | str, close_price: Column | str) -> Column:
    return F.when(_c(close_price) >= _c(open_price), "up").otherwise("down")


def clamp_pct(x: Column | str) -> Column:
    """Range marker position: clamp to [0, 100], NULL -> 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(_c(x).cast("double"), F.lit(0.0))))
