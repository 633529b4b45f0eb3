"""Column-level helpers: pure expressions over built-in functions (no UDFs)."""

from candlewick.functions.timeutil import (  # noqa: F401
    bucket_start, epoch_seconds, iso_utc, market_date, market_is_open, market_local, parse_utc, to_utc_ntz,
)
from candlewick.functions.quotes import (  # noqa: F401
    candle_direction, change_pct, clamp_pct, direction, expected_source, feed_delay_seconds, safe_double,
    staleness_class,
)
