"""Delivery margins against the latest regional diesel price (B-08, B-09,
B-20..B-22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.config import (
    DEFAULT,
    MARGIN_HEALTHY,
    MARGIN_WARNING,
    MARGIN_WATCH,
    Config,
)
from pricelens.functions.numeric import round_exact
from pricelens.operators.series import latest
from pricelens.sources.tables import require_zone_columns

MARGIN_COLUMNS = (
    "duoarea", "zone_name", "padd_region", "region_name", "deliveries_per_week",
    "avg_miles_per_delivery", "revenue_per_delivery", "base_cost_per_delivery", "fleet_mpg",
    "latitude", "longitude", "diesel_price", "diesel_wow_change", "price_date",
    "fuel_cost_per_delivery", "margin_per_delivery", "margin_pct", "weekly_fuel_cost",
    "weekly_margin",
)


def latest_prices(regional: DataFrame, product: str) -> DataFrame:
    """Rows of ``product`` at its latest date over all areas."""
    one = regional.filter(F.col("product") == product)
    return latest(one).select("duoarea", "area_name", "price_per_gallon", "wow_change", "price_date")


def delivery_margins(regional: DataFrame, zones: DataFrame, cfg: Config = DEFAULT,
                     product: str | None = None) -> DataFrame:
    """B-08: every zone priced at the latest diesel price of its region.

    Zones whose region has no price drop (inner join); duplicate prices fan
    out.  Every output is rounded once from unrounded inputs; the fuel cost
    per delivery is named once and reused.  The price side is one date of
    one product; it is joined as a plan, no job runs while the query is
    built, and the adaptive planner broadcasts it once its size is known.
    """
    zones = require_zone_columns(zones)
    prices = latest_prices(regional, product or cfg.diesel_product)
    joined = zones.join(prices.withColumnRenamed("duoarea", "_price_area"),
                        F.col("padd_region") == F.col("_price_area"), "inner")
    fuel = (F.col("avg_miles_per_delivery") / F.col("fleet_mpg")) * F.col("price_per_gallon")
    with_fuel = joined.withColumn("_fuel", fuel)
    margin = F.col("revenue_per_delivery") - F.col("base_cost_per_delivery") - F.col("_fuel")
    return with_fuel.select(
        "duoarea", "zone_name", "padd_region",
        F.col("area_name").alias("region_name"),
        "deliveries_per_week", "avg_miles_per_delivery", "revenue_per_delivery",
        "base_cost_per_delivery", "fleet_mpg", "latitude", "longitude",
        F.col("price_per_gallon").alias("diesel_price"),
        F.col("wow_change").alias("diesel_wow_change"),
        "price_date",
        round_exact("_fuel", 2).alias("fuel_cost_per_delivery"),
        round_exact(margin, 2).alias("margin_per_delivery"),
        round_exact(F.try_divide(margin, F.col("revenue_per_delivery")) * F.lit(100.0), 1).alias("margin_pct"),
        round_exact(F.col("_fuel") * F.col("deliveries_per_week"), 0).alias("weekly_fuel_cost"),
        round_exact(margin * F.col("deliveries_per_week"), 0).alias("weekly_margin"),
    )


def margins_by_pct(margins: DataFrame) -> DataFrame:
    """B-09: margins read, worst margin first (zone code breaks ties)."""
    return margins.orderBy("margin_pct", "duoarea")


def status_column(pct) -> F.Column:
    """B-20: >25 healthy, >15 watch, >5 warning, else critical.  A missing
    margin reads as 0 (critical)."""
    p = F.coalesce(F.col(pct) if isinstance(pct, str) else pct, F.lit(0.0))
    return (F.when(p > MARGIN_HEALTHY, F.lit("healthy"))
            .when(p > MARGIN_WATCH, F.lit("watch"))
            .when(p > MARGIN_WARNING, F.lit("warning"))
            .otherwise(F.lit("critical")))


def marker_radius(deliveries) -> F.Column:
    """F-15: map marker radius, sqrt(deliveries / 15), at least 4."""
    d = F.col(deliveries) if isinstance(deliveries, str) else deliveries
    return F.greatest(F.lit(4.0), F.sqrt(d / F.lit(15)))


def margin_status(margins: DataFrame) -> DataFrame:
    """Margins with their status label and marker radius."""
    return margins.withColumns({"status": status_column("margin_pct"),
                                "marker_radius": marker_radius("deliveries_per_week")})


def zone_detail(margins: DataFrame, code: str) -> DataFrame:
    """P-21: one zone by its code (detail panel)."""
    return margins.filter(F.col("duoarea") == code)


def fleet_totals(with_status: DataFrame) -> DataFrame:
    """B-21: weekly fuel cost and margin over all zones, zone count, and
    zones at risk (warning or critical, i.e. margin <= 15 %)."""
    return with_status.agg(
        F.sum("weekly_fuel_cost").alias("total_weekly_fuel_cost"),
        F.sum("weekly_margin").alias("total_weekly_margin"),
        F.count(F.lit(1)).alias("zone_count"),
        F.count_if(F.col("status").isin("warning", "critical")).alias("zones_at_risk"),
    )


def state_bridge(zone_states: DataFrame) -> DataFrame:
    """Zone -> state list as a two-column bridge table."""
    return zone_states.select("duoarea", F.explode("states").alias("state"))


def state_rollup(with_status: DataFrame, bridge: DataFrame) -> DataFrame:
    """B-22: the worst zone (lowest margin %, then zone code) of each state.

    A ``min(struct)`` hash aggregation per state: partial aggregates are
    formed map-side, so a state holding a large share of all zones is
    reduced before the shuffle (no window over a hot state partition).  The
    planner picks the join with the bridge by its size."""
    cols = ["duoarea", "zone_name", "margin_pct", "status", "weekly_margin", "diesel_price"]
    joined = bridge.join(with_status.select(*cols), "duoarea")
    ranked = F.struct(F.coalesce(F.col("margin_pct"), F.lit(0.0)).alias("_k"),
                      *[F.col(c) for c in cols])
    return (joined.groupBy("state").agg(F.min(ranked).alias("w"))
            .select("state", *[F.col(f"w.{c}").alias(c) for c in cols]))
