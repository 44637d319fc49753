"""Keyed weekly series: lags, trailing means, "latest" slices (B-04, B-05).

All frames are row based: "4 weeks back" is 4 rows back, whatever the
calendar gap.  Lags and trailing means over the same key and order are put
in one ``select`` so Catalyst plans a single Exchange + Sort + Window.

Window partitions are series (product, or product x area).  A series holds
one row per week, so a partition is bounded by the calendar (about 52 rows
a year), not by the data volume; parallelism comes from the number of
series.  ``duplicate_keys`` checks that bound (unique key + date).  For series
too long for one task, the ``_blocked`` forms cut the windows (``blocks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.config import DEFAULT, Config
from pricelens.functions.numeric import pct_change, round_exact
from pricelens.operators.blocks import BLOCK_DAYS, blocked, day_block

def series_window(keys: Sequence[str], order: str = "price_date"):
    return Window.partitionBy(*keys).orderBy(order)


def lag_value(value: str, keys: Sequence[str], n: int = 1, order: str = "price_date") -> Column:
    """Value ``n`` rows back in the series."""
    return F.lag(value, n).over(series_window(keys, order))


def trailing_mean(value: str, keys: Sequence[str], rows: int, order: str = "price_date") -> Column:
    """Mean over the current and ``rows - 1`` previous rows (short at the start)."""
    return F.avg(value).over(series_window(keys, order).rowsBetween(-(rows - 1), 0))


def duplicate_keys(df: DataFrame, keys: Sequence[str], order: str = "price_date") -> DataFrame:
    """(keys, order) combinations that occur more than once, with counts."""
    return (df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def latest(df: DataFrame, scope: Sequence[str] = (), order: str = "price_date") -> DataFrame:
    """Rows at the greatest ``order`` value, the maximum taken per ``scope``
    (``scope=()``: of the whole table).

    One pass: a rank that is planned as a partial and a final
    WindowGroupLimit, so every task keeps only its own newest rows before
    the shuffle.  Rows without an ``order`` value are never the latest."""
    return newest_rows(df.filter(F.col(order).isNotNull()), scope, 1, order)


# Rows one output row of the weekly summary can look back over (12-row mean).
WEEKLY_LOOKBACK = 12


def newest_rows(df: DataFrame, keys: Sequence[str], n: int, order: str = "price_date") -> DataFrame:
    """Every row of the newest ``n`` dates of each series.  ``dense_rank``
    keeps rows that share a date (nothing is dropped); ``<= n`` is planned as
    a partial + final WindowGroupLimit, so each task cuts before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_rk", F.dense_rank().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def weekly_summary(silver: DataFrame, cfg: Config = DEFAULT, newest: int | None = None) -> DataFrame:
    """B-04: national series of the tracked products with week-over-week,
    4-row and 12-row trailing means and the 4-rows-back change.

    ``newest``: compute only the newest ``newest`` dates of each series.  The
    windows then see the newest ``newest + 11`` dates (at least that many
    rows), which is exact for the kept rows (a 12-row mean looks back 11
    rows) and spares the history when only the latest week is read."""
    keys = ["product"]
    national = national_rows(silver, cfg)
    if newest is not None:
        national = newest_rows(national, keys, newest + WEEKLY_LOOKBACK - 1)
    with_windows = national.select(*WEEKLY_INPUT, *[
        c.alias(n) for n, c in weekly_windows(series_window(keys)).items()])
    if newest is not None:
        with_windows = newest_rows(with_windows, keys, newest)
    return weekly_measures(with_windows)


WEEKLY_INPUT = ("price_date", "product", "product_name", "product_category", "price_per_gallon")


def weekly_windows(w) -> dict[str, Column]:
    """The lags and trailing means of the weekly summary over ``w``."""
    p = F.col("price_per_gallon")
    return {"prev_week_price": F.lag(p, 1).over(w),
            "_avg4": F.avg(p).over(w.rowsBetween(-3, 0)),
            "_avg12": F.avg(p).over(w.rowsBetween(-(WEEKLY_LOOKBACK - 1), 0)),
            "price_4wk_ago": F.lag(p, 4).over(w)}


def weekly_measures(with_windows: DataFrame) -> DataFrame:
    """The weekly summary's columns from its window columns."""
    p, prev_c, back4_c = F.col("price_per_gallon"), F.col("prev_week_price"), F.col("price_4wk_ago")
    return with_windows.select(
        *WEEKLY_INPUT, "prev_week_price",
        round_exact(p - prev_c, 4).alias("wow_change"),
        round_exact(pct_change(p, prev_c), 2).alias("wow_pct_change"),
        round_exact("_avg4", 4).alias("avg_4wk"),
        round_exact("_avg12", 4).alias("avg_12wk"),
        "price_4wk_ago",
        round_exact(p - back4_c, 4).alias("mom_change"),
    )


def national_rows(silver: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """What the weekly summary is computed from."""
    return (silver.filter(F.col("area_name") == cfg.national_area)
            .filter(F.col("product").isin(list(cfg.national_products))).select(*WEEKLY_INPUT))


def weekly_summary_blocked(silver: DataFrame, cfg: Config = DEFAULT, block_days: int = BLOCK_DAYS,
                           targets: DataFrame | None = None) -> DataFrame:
    """B-04 with the windows cut into blocks of days (see ``blocks``): the
    same values, with as many tasks as blocks instead of products."""
    rows = blocked(national_rows(silver, cfg), ["product"], "price_date", WEEKLY_LOOKBACK - 1,
                   day_block("price_date", block_days), weekly_windows, targets)
    return weekly_measures(rows)


REGIONAL_INPUT = ("price_date", "product", "product_name", "product_category", "duoarea", "area_name",
                  "price_per_gallon")


def regional_rows(silver: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """What the regional comparison is computed from."""
    return silver.filter(F.col("product").isin(list(cfg.regional_products))).select(*REGIONAL_INPUT)


def regional_comparison_blocked(silver: DataFrame, cfg: Config = DEFAULT, block_days: int = BLOCK_DAYS,
                                targets: DataFrame | None = None) -> DataFrame:
    """B-05 in blocks of days."""
    rows = blocked(regional_rows(silver, cfg), ["product", "duoarea"], "price_date", 1,
                   day_block("price_date", block_days),
                   lambda w: {"prev_week_price": F.lag("price_per_gallon", 1).over(w)}, targets)
    return rows.withColumn("wow_change", round_exact(F.col("price_per_gallon") - F.col("prev_week_price"), 4))


def regional_comparison(silver: DataFrame, cfg: Config = DEFAULT,
                        newest: int | None = None) -> DataFrame:
    """B-05: every area (national row included) of the regional products,
    with the previous week per (product, area).

    ``newest``: only the newest ``newest`` dates of each (product, area)
    series, computed from the newest ``newest + 1`` dates (one row of
    lookback): what reads of the latest week need."""
    keys = ["product", "duoarea"]
    regional = silver.filter(F.col("product").isin(list(cfg.regional_products)))
    if newest is not None:
        regional = newest_rows(regional, keys, newest + 1)
    prev = lag_value("price_per_gallon", keys, 1)
    out = regional.select(
        "price_date", "product", "product_name", "product_category", "duoarea",
        "area_name", "price_per_gallon", prev.alias("prev_week_price"),
    )
    if newest is not None:
        out = newest_rows(out, keys, newest)
    return out.withColumn("wow_change", round_exact(F.col("price_per_gallon") - F.col("prev_week_price"), 4))
