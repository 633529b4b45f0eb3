"""pt-BR display columns for the consolidated board (P30), as expressions.

Numbers use ``.`` for thousands and ``,`` for decimals; NULL renders as ``--``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.config import CURRENCY_PREFIX, NULL_TEXT


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def num_ptbr(x: Column | str, digits: int = 2) -> Column:
    """1234567.891 -> '1.234.567,89'."""
    v = _c(x).cast("double")
    return F.when(v.isNull(), F.lit(NULL_TEXT)).otherwise(
        F.translate(F.format_number(v, digits), ",.", ".,"))


def brl(x: Column | str) -> Column:
    v = _c(x)
    return F.when(v.isNull(), F.lit(NULL_TEXT)).otherwise(F.concat(F.lit(CURRENCY_PREFIX), num_ptbr(v)))


def compact(x: Column | str) -> Column:
    """Compact magnitude with k/M/B/T suffixes and one decimal."""
    v = _c(x).cast("double")
    out = num_ptbr(v, 0)
    for limit, suffix in ((1e3, "k"), (1e6, "M"), (1e9, "B"), (1e12, "T")):
        out = F.when(F.abs(v) >= limit, F.concat(num_ptbr(v / limit, 1), F.lit(suffix))).otherwise(out)
    return F.when(v.isNull(), F.lit(NULL_TEXT)).otherwise(out)


def signed_pct(x: Column | str) -> Column:
    v = _c(x).cast("double")
    sign = F.when(v > 0, F.lit("+")).otherwise(F.lit(""))
    return F.when(v.isNull(), F.lit(NULL_TEXT)).otherwise(F.concat(sign, num_ptbr(v), F.lit("%")))


def human_age(seconds: Column | str) -> Column:
    """< 90 s -> '42s'; < 90 min -> '12min'; otherwise '3h07'."""
    s = _c(seconds).cast("double").cast("long")
    return (F.when(s.isNull(), F.lit(NULL_TEXT))
            .when(s < 90, F.concat(s.cast("string"), F.lit("s")))
            .when(s < 5400, F.concat(F.floor(s / 60).cast("string"), F.lit("min")))
            .otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit("h"),
                                F.lpad(F.floor(F.pmod(s, F.lit(3600)) / 60).cast("string"), 2, "0"))))
