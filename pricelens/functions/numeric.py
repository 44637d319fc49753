"""Scalar column functions shared by all operators.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_exact(c: ColumnOrName, scale: int) -> Column:
    """Half-up rounding on the decimal value of a double.

    The double is first brought to 8 decimal places (which absorbs binary
    noise such as 1.00499999... for 1.005), then rounded half-up to
    ``scale`` places and returned as a double.  NaN and values of 1e29 and more
    become null (``try_cast``; a plain cast would fail the job under ANSI).
    """
    return F.round(_c(c).try_cast("decimal(38,8)"), scale).cast("double")


def exact_sum(c: ColumnOrName) -> Column:
    """Order-independent sum of a money-like double (decimal accumulation)."""
    return F.sum(_c(c).try_cast("decimal(38,8)"))


def exact_mean(c: ColumnOrName) -> Column:
    """Mean whose value does not depend on partitioning or row order."""
    return F.try_divide(exact_sum(c).cast("double"), F.count(_c(c)).cast("double"))


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """(new - old) / old * 100; null when old is 0 or null."""
    return F.try_divide(_c(new) - _c(old), _c(old)) * F.lit(100.0)


def js_round(c: ColumnOrName) -> Column:
    """Whole-number rounding with halves toward +infinity (floor(x + 0.5))."""
    return F.floor(_c(c) + F.lit(0.5)).cast("double")


def floor_zero(c: ColumnOrName) -> Column:
    """max(0, x) that keeps null as null."""
    x = _c(c)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(0.0), x))


def nullif_zero(c: ColumnOrName) -> Column:
    """Treat 0 like a missing value (script truthiness of a number)."""
    x = _c(c)
    return F.when(x == 0, F.lit(None).cast("double")).otherwise(x)


def direction(c: ColumnOrName, null_label: str | None = None) -> Column:
    """'up' above zero, 'down' below, 'flat' at zero; ``null_label`` for null."""
    x = _c(c)
    return (F.when(x.isNull(), F.lit(null_label).cast("string"))
            .when(x > 0, F.lit("up"))
            .when(x < 0, F.lit("down"))
            .otherwise(F.lit("flat")))


def minmax_position(c: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Position of x between lo and hi in percent; null when hi == lo."""
    return F.try_divide(_c(c) - _c(lo), _c(hi) - _c(lo)) * F.lit(100.0)
