"""Fuel surcharge what-if (B-25..B-29, A-05, A-11).

Scenario grids are generated per row with ``explode(sequence(...))`` over
integer steps (divided afterwards, so 0.35 is exactly the double 0.35): no
join against a parameter table and no cartesian product operator.  Output
grows linearly with input rows x grid points, both explicit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.config import (
    BASELINE_GRID_CENTS,
    DEFAULT_MEAN_PRICE,
    RATE_GRID_CENTS,
    RECOVERY_GOOD,
    RECOVERY_PARTIAL,
    SURCHARGE_STEP,
    UI_BASELINE,
    UI_RATE,
    Fleet,
)
from pricelens.functions.numeric import exact_mean, floor_zero, js_round, nullif_zero, round_exact

POINT_COLUMNS = (
    "avg_price", "baseline_fuel_price", "surcharge_rate", "above_baseline",
    "extra_fuel_cost_per_delivery", "surcharge_per_delivery", "weekly_extra_fuel_cost",
    "weekly_surcharge_revenue", "weekly_gap", "recovery_pct", "break_even_rate",
    "recovery_band",
)


def fleet_from_zones(zones: DataFrame) -> DataFrame:
    """A-11 derived: total weekly deliveries, delivery-weighted miles and
    gallons per delivery, from the zone table (one row)."""
    d = F.col("deliveries_per_week").cast("double")
    return zones.agg(
        F.sum("deliveries_per_week").cast("long").alias("weekly_deliveries"),
        (F.sum(d * F.col("avg_miles_per_delivery")) / F.sum(d)).alias("_miles"),
        (F.sum(d * F.col("avg_miles_per_delivery") / F.col("fleet_mpg")) / F.sum(d)).alias("_gal"),
    ).select("weekly_deliveries",
             round_exact("_miles", 6).alias("miles_per_delivery"),
             round_exact("_gal", 6).alias("gallons_per_delivery"))


def break_even_rate(gallons_per_delivery) -> Column:
    """B-26: rate per $0.10 step that exactly covers the extra fuel cost."""
    g = F.col(gallons_per_delivery) if isinstance(gallons_per_delivery, str) else F.lit(float(gallons_per_delivery))
    return g * F.lit(SURCHARGE_STEP)


def recovery_band(recovery_pct: Column, above: Column) -> Column:
    """B-29: >= 100 good, >= 70 partial, else poor; no band at or below baseline."""
    return (F.when(~(above > 0), F.lit(None).cast("string"))
            .when(recovery_pct >= RECOVERY_GOOD, F.lit("good"))
            .when(recovery_pct >= RECOVERY_PARTIAL, F.lit("partial"))
            .otherwise(F.lit("poor")))


def _point(avg: Column, baseline: Column, rate: Column, fleet: Fleet) -> list[Column]:
    gallons = F.lit(float(fleet.gallons_per_delivery))
    deliveries = F.lit(float(fleet.weekly_deliveries))
    above = F.greatest(F.lit(0.0), avg - baseline)
    extra = above * gallons
    surcharge = above / F.lit(SURCHARGE_STEP) * rate
    weekly_extra = extra * deliveries
    weekly_rev = surcharge * deliveries
    recovery = F.when(weekly_extra > 0, weekly_rev / weekly_extra * F.lit(100.0)).otherwise(F.lit(100.0))
    r6 = lambda c: round_exact(c, 6)
    return [
        r6(avg).alias("avg_price"), baseline.alias("baseline_fuel_price"),
        rate.alias("surcharge_rate"), r6(above).alias("above_baseline"),
        r6(extra).alias("extra_fuel_cost_per_delivery"), r6(surcharge).alias("surcharge_per_delivery"),
        r6(weekly_extra).alias("weekly_extra_fuel_cost"), r6(weekly_rev).alias("weekly_surcharge_revenue"),
        r6(weekly_rev - weekly_extra).alias("weekly_gap"), r6(recovery).alias("recovery_pct"),
        r6(break_even_rate(fleet.gallons_per_delivery)).alias("break_even_rate"),
        recovery_band(recovery, above).alias("recovery_band"),
    ]


def mean_latest_price(latest_rows: DataFrame, default: float = DEFAULT_MEAN_PRICE) -> DataFrame:
    """A-05: unweighted mean of the latest regional prices (one row);
    ``default`` when there are none."""
    return latest_rows.agg(
        F.coalesce(exact_mean("price_per_gallon"), F.lit(float(default))).alias("avg_price"))


def surcharge_point(latest_rows: DataFrame, baseline: float = UI_BASELINE, rate: float = UI_RATE,
                    fleet: Fleet = Fleet()) -> DataFrame:
    """B-25: one scenario over the mean latest regional price."""
    mean = mean_latest_price(latest_rows)
    return mean.select(*_point(F.col("avg_price"), F.lit(float(baseline)), F.lit(float(rate)), fleet))


def _grid(cents: tuple[int, int, int]) -> Column:
    lo, hi, step = cents
    return F.transform(F.sequence(F.lit(lo), F.lit(hi), F.lit(step)), lambda i: i.cast("double") / F.lit(100.0))


def surcharge_scenarios(latest_rows: DataFrame, fleet: Fleet = Fleet(),
                        rate_cents: tuple[int, int, int] = RATE_GRID_CENTS,
                        baseline_cents: tuple[int, int, int] = BASELINE_GRID_CENTS) -> DataFrame:
    """B-28: B-25 at every (baseline, rate) point of the slider grids."""
    mean = mean_latest_price(latest_rows)
    grid = (mean.select("avg_price", F.explode(_grid(baseline_cents)).alias("_b"))
            .select("avg_price", "_b", F.explode(_grid(rate_cents)).alias("_r")))
    return grid.select(*_point(F.col("avg_price"), F.col("_b"), F.col("_r"), fleet))


def series_price(actual: Column, forecast: Column) -> Column:
    """P-19: the first non-missing price, actual before forecast; a zero
    counts as missing."""
    return F.coalesce(nullif_zero(actual), nullif_zero(forecast))


def surcharge_series(bridged: DataFrame, baseline: float = UI_BASELINE, rate: float = UI_RATE,
                     fleet: Fleet = Fleet()) -> DataFrame:
    """B-27: weekly extra fuel cost and surcharge revenue per date, whole
    units, over actual-or-forecast prices."""
    price = series_price(F.col("actual_price"), F.col("forecast_price"))
    rows = bridged.filter(F.col("price_date").isNotNull() & price.isNotNull())
    above = floor_zero(price - F.lit(float(baseline)))
    gallons = F.lit(float(fleet.gallons_per_delivery))
    deliveries = F.lit(float(fleet.weekly_deliveries))
    keep = [c for c in ("product",) if c in bridged.columns]
    return rows.select(
        *keep, "price_date",
        js_round(above * gallons * deliveries).alias("extra_fuel_cost"),
        js_round(above / F.lit(SURCHARGE_STEP) * F.lit(float(rate)) * deliveries).alias("surcharge_revenue"),
        F.col("is_forecast"),
    )


def surcharge_series_grid(bridged: DataFrame, fleet: Fleet = Fleet(),
                          rate_cents: tuple[int, int, int] = RATE_GRID_CENTS,
                          baseline_cents: tuple[int, int, int] = BASELINE_GRID_CENTS) -> DataFrame:
    """B-27 over the whole slider grid, every date x scenario."""
    price = series_price(F.col("actual_price"), F.col("forecast_price"))
    rows = bridged.filter(F.col("price_date").isNotNull() & price.isNotNull()).withColumn("_p", price)
    grid = (rows.select("*", F.explode(_grid(baseline_cents)).alias("baseline_fuel_price"))
            .select("*", F.explode(_grid(rate_cents)).alias("surcharge_rate")))
    above = floor_zero(F.col("_p") - F.col("baseline_fuel_price"))
    deliveries = F.lit(float(fleet.weekly_deliveries))
    keep = [c for c in ("product",) if c in bridged.columns]
    return grid.select(
        *keep, "price_date", "baseline_fuel_price", "surcharge_rate",
        js_round(above * F.lit(float(fleet.gallons_per_delivery)) * deliveries).alias("extra_fuel_cost"),
        js_round(above / F.lit(SURCHARGE_STEP) * F.col("surcharge_rate") * deliveries).alias("surcharge_revenue"),
        "is_forecast",
    )


def scenario_totals(prices: DataFrame, fleet: Fleet = Fleet(),
                    rate_cents: tuple[int, int, int] = RATE_GRID_CENTS,
                    baseline_cents: tuple[int, int, int] = BASELINE_GRID_CENTS,
                    by: tuple[str, ...] = ("product",)) -> DataFrame:
    """B-25/B-28 over whole series: the totals of every (baseline, rate) point
    per ``by``, from rows with ``actual_price`` and ``forecast_price``.

    No price meets the grid.  Each falls into the bucket of the baselines below
    it, found by arithmetic and summed before the shuffle, so a series of any
    length leaves at most one row for each baseline.  Running sums from the
    highest bucket down then give, at a baseline b, the sum over the prices
    above b of (price - b).  Prices count in whole millionths, so the sums are
    exact.  Rows without a price or a date add nothing; a series without prices
    has no rows.
    """
    low, high, step = (c * 10_000 for c in baseline_cents)  # millionths
    points = (high - low) // step + 1
    keys = list(by)
    price = round_exact(series_price(F.col("actual_price"), F.col("forecast_price")), 6)
    micro = (price.cast("decimal(24,6)") * F.lit(1_000_000)).cast("long")
    rows = prices.filter(F.col("price_date").isNotNull()).select(*keys, micro.alias("p")).filter("p is not null")
    below = F.least(F.lit(points), F.greatest(F.lit(0), F.expr(f"(p - {low} + {step - 1}) div {step}")))
    none = F.lit(0).cast("decimal(38,0)")
    buckets = rows.groupBy(*keys, below.cast("long").alias("k")).agg(
        F.sum(F.col("p").cast("decimal(20,0)")).cast("decimal(38,0)").alias("s"), F.count("*").alias("n"))
    marks = (buckets.select(*keys).distinct()
             .select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))).alias("k"),
                     none.alias("s"), F.lit(0).cast("long").alias("n")))
    line = buckets.unionByName(marks).groupBy(*keys, "k").agg(
        F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n"))
    higher = (Window.partitionBy(*keys).orderBy(F.col("k").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    base = F.lit(low) + F.col("k") * F.lit(step)
    at = line.withColumns({"s": F.sum("s").over(higher), "n": F.sum("n").over(higher)}).filter(F.col("k") < points)
    total = F.coalesce(F.col("s"), none) - (F.coalesce(F.col("n"), F.lit(0)) * base).cast("decimal(38,0)")
    at = at.select(*keys, (base / F.lit(10_000).cast("long")).alias("c"), F.coalesce("n", F.lit(0)).alias("weeks_above"),
                   (total.cast("double") / F.lit(1_000_000.0)).alias("above"))
    grid = at.select("*", (F.col("c") / F.lit(100.0)).alias("baseline_fuel_price"),
                     F.explode(_grid(rate_cents)).alias("surcharge_rate"))
    deliveries = F.lit(float(fleet.weekly_deliveries))
    extra = F.col("above") * F.lit(float(fleet.gallons_per_delivery)) * deliveries
    revenue = F.col("above") / F.lit(SURCHARGE_STEP) * F.col("surcharge_rate") * deliveries
    recovery = F.when(extra > 0, revenue / extra * F.lit(100.0)).otherwise(F.lit(100.0))
    return grid.select(
        *keys, "baseline_fuel_price", "surcharge_rate", "weeks_above",
        round_exact("above", 6).alias("total_above_baseline"), round_exact(extra, 6).alias("total_extra_fuel_cost"),
        round_exact(revenue, 6).alias("total_surcharge_revenue"), round_exact(revenue - extra, 6).alias("total_gap"),
        round_exact(recovery, 6).alias("recovery_pct"), recovery_band(recovery, F.col("above")).alias("recovery_band"))
