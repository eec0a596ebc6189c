"""Display formats as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockpulse.functions.columns import col

RUPEE = "₹"
CRORE = 1e7
LAKH = 1e5


def money_plain(c) -> Column:
    """``₹1,234`` (no decimals)."""
    return F.concat(F.lit(RUPEE), F.format_number(col(c), 0))


def money(c) -> Column:
    """``₹1.23 Cr`` / ``₹4.56 L`` / ``₹789`` by magnitude; ``₹0`` for NULL."""
    x = col(c).cast("double")
    return (F.when(x.isNull(), F.lit(RUPEE + "0"))
             .when(F.abs(x) >= CRORE, F.concat(F.lit(RUPEE), F.format_number(x / CRORE, 2), F.lit(" Cr")))
             .when(F.abs(x) >= LAKH, F.concat(F.lit(RUPEE), F.format_number(x / LAKH, 2), F.lit(" L")))
             .otherwise(F.concat(F.lit(RUPEE), F.format_number(x, 0))))


def pct(c) -> Column:
    """``12.3%`` from a ratio; ``0.0%`` for NULL."""
    x = col(c).cast("double")
    return F.when(x.isNull(), F.lit("0.0%")).otherwise(F.concat(F.format_string("%.1f", x * 100), F.lit("%")))


def number(c) -> Column:
    """``1,234``; ``0`` for NULL."""
    return F.coalesce(F.format_number(col(c).cast("double"), 0), F.lit("0"))


def guarded_ratio(num, den) -> Column:
    """num / den, 0 when the denominator is 0 or NULL."""
    d = col(den)
    return F.when(F.coalesce(d, F.lit(0)) != 0, col(num) / d).otherwise(F.lit(0.0))
