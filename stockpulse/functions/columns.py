"""Column-level helpers shared by every stage.

All helpers return native ``Column`` expressions, so they stay inside
whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lower=None, upper=None) -> Column:
    """Clip to [lower, upper]; NULL stays NULL (``greatest`` alone skips NULLs)."""
    x = col(c)
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(x.isNotNull(), out)


def round_half_up(c, n: int) -> Column:
    """Round half-up through DECIMAL(38, 9).

    The detour fixes the decimal digits first, so any engine applying the
    same rule gets the same result for values that sit on a tie.
    """
    return F.round(col(c).try_cast("decimal(38,9)"), n).cast("double")


def clip01(c) -> Column:
    return clip(c, 0.0, 1.0)


def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def coerce_double(df: DataFrame, name: str) -> Column:
    """Coerce any column to double; unparsable text, NaN and inf become NULL."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        c = F.trim(F.col(name)).try_cast("double")
    elif isinstance(dtype, T.BooleanType):
        c = F.col(name).cast("int").cast("double")
    else:
        c = F.col(name).cast("double")
    return nan_to_null(c)


def coerce_date(df: DataFrame, name: str) -> Column:
    """Coerce to DATE; unparsable text becomes NULL (ANSI-safe)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(name))
    return F.to_date(F.try_to_timestamp(F.trim(F.col(name).cast("string"))))


def coerce_bool(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        return F.col(name)
    if isinstance(dtype, T.StringType):
        return F.lower(F.trim(F.col(name))).isin("true", "1", "yes", "t", "y")
    return F.col(name).cast("double") != F.lit(0.0)


def week_floor(c) -> Column:
    """Monday of the week containing the date."""
    return F.to_date(F.date_trunc("week", col(c)))


def wape(actual, forecast) -> Column:
    """Weighted absolute percentage error as an aggregate expression.

    Falls back to the mean absolute error when the actuals sum to zero.
    """
    a, f = col(actual), col(forecast)
    denom = F.sum(F.abs(a))
    return F.when(denom == 0, F.avg(F.abs(a - f))).otherwise(F.sum(F.abs(a - f)) / denom)


def bias(actual, forecast) -> Column:
    """Signed forecast bias; zero when the actuals sum to zero."""
    a, f = col(actual), col(forecast)
    denom = F.sum(F.abs(a))
    return F.when(denom == 0, F.lit(0.0)).otherwise(F.sum(f - a) / denom)


def mae(actual, forecast) -> Column:
    return F.avg(F.abs(col(actual) - col(forecast)))


def count_if(cond) -> Column:
    return F.count_if(col(cond))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add each absent column with a literal default (present ones are kept)."""
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df
