"""Ordered full refresh of the bronze, silver and gold tables (B-33).

Every step reads the table the previous step wrote, so a step can be re-run
alone, a failure stops the run at that step, and the written tables cut the
lineage (a lost executor never forces a recomputation back to the source).
Every write is a full overwrite: running twice gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pricelens.config import DEFAULT, Config
from pricelens.operators import forecast as fc
from pricelens.operators import series, silver
from pricelens.plans.ledger import Step, StepLedger, content_version
from pricelens.sources import pages as pg
from pricelens.sources import tables as tb

FORECAST_MODELS = {"additive": fc.additive_forecast, "linear_seasonal": fc.linear_seasonal_forecast}


def _rx(expr: str, n: int) -> str:
    return f"CAST(ROUND(TRY_CAST(({expr}) AS DECIMAL(24,8)), {n}) AS DOUBLE)"


def margin_view_sql(cfg: Config = DEFAULT) -> str:
    """Text that creates the delivery margin view (S-12): every zone at the
    newest diesel price of its region."""
    gold, product = cfg.database("gold"), cfg.diesel_product
    fuel = "(avg_miles_per_delivery / fleet_mpg) * diesel_price"
    left_over = f"(revenue_per_delivery - base_cost_per_delivery - {fuel})"
    measures = {
        "fuel_cost_per_delivery": (fuel, 2),
        "margin_per_delivery": (left_over, 2),
        "margin_pct": (f"try_divide({left_over}, revenue_per_delivery) * 100.0D", 1),
        "weekly_fuel_cost": (f"{fuel} * deliveries_per_week", 0),
        "weekly_margin": (f"{left_over} * deliveries_per_week", 0),
    }
    zone = ("duoarea", "zone_name", "padd_region", "deliveries_per_week", "avg_miles_per_delivery",
            "revenue_per_delivery", "base_cost_per_delivery", "fleet_mpg", "latitude", "longitude")
    price = {"region_name": "area_name", "diesel_price": "price_per_gallon",
             "diesel_wow_change": "wow_change", "price_date": "price_date"}
    ranked = ", ".join(f"{c} AS {name}" for name, c in price.items())
    shown = [*zone, *price, *(f"{_rx(e, n)} AS {name}" for name, (e, n) in measures.items())]
    return (f"CREATE OR REPLACE VIEW {gold}.delivery_margins AS SELECT {', '.join(shown)} "
            f"FROM (SELECT duoarea AS price_area, {ranked}, RANK() OVER (ORDER BY price_date DESC) AS age "
            f"FROM {gold}.regional_comparison WHERE product = '{product}' AND price_date IS NOT NULL) "
            f"JOIN {gold}.delivery_zones ON price_area = padd_region WHERE age = 1")


@dataclass
class RefreshInputs:
    """What a refresh loads: raw records or landed pages, and the zones."""

    zones: DataFrame
    records: DataFrame | None = None
    pages_path: str | None = None
    surcharge_config: DataFrame | None = None


def refresh_steps(spark: SparkSession, inputs: RefreshInputs, cfg: Config = DEFAULT, as_of=None,
                  model: str = "additive", check_pages: bool = True) -> list[Step]:
    """The tables of a refresh in their order, each with what it follows.
    ``source``, ``zones_in`` and ``config_in`` are outside inputs."""
    t = cfg.table

    def bronze() -> int:
        if inputs.pages_path is not None:
            landed = pg.read_pages(spark, inputs.pages_path)
            if check_pages:
                pg.require_complete(landed)
            raw = pg.flatten_pages(landed)
        else:
            raw = inputs.records
        return tb.write_table(pg.bronze_records(raw, cfg, as_of, dedupe=True), t("bronze", "fuel_prices_raw"),
                              evolve="reconcile", partition_by=["period"])

    def silver_rows() -> int:
        rows = silver.silver_prices(spark.table(t("bronze", "fuel_prices_raw")), cfg)
        return tb.write_table(rows, t("silver", "fuel_prices"), evolve="reconcile", partition_by=["product"])

    def gold(build, source: str, name: str):
        return lambda: tb.write_table(build(spark.table(source), cfg), t("gold", name), evolve="reconcile")

    def zones() -> int:
        rows = tb.require_zone_columns(inputs.zones).select(*tb.ZONE_COLUMNS)
        return tb.write_table(rows, t("gold", "delivery_zones"), evolve=True)

    def config() -> int:
        rows = inputs.surcharge_config or tb.surcharge_config_frame(spark)
        return tb.write_table(rows, t("gold", "surcharge_config"), evolve="reconcile")

    if inputs.records is None and inputs.pages_path is None:
        raise ValueError("refresh needs records or a pages path")
    if model not in FORECAST_MODELS:
        raise ValueError(f"unknown forecast model: {model}")
    own, silver_table, weekly_table = repr(cfg), t("silver", "fuel_prices"), t("gold", "weekly_fuel_summary")
    return [
        Step("bronze", t("bronze", "fuel_prices_raw"), ("source",), bronze, f"{own} {as_of} {check_pages}"),
        Step("silver", silver_table, ("bronze",), silver_rows, own),
        Step("weekly", weekly_table, ("silver",), gold(series.weekly_summary, silver_table, "weekly_fuel_summary"), own),
        Step("regional", t("gold", "regional_comparison"), ("silver",),
             gold(series.regional_comparison, silver_table, "regional_comparison"), own),
        Step("forecast", t("gold", "fuel_price_forecast"), ("weekly",),
             gold(FORECAST_MODELS[model], weekly_table, "fuel_price_forecast"), f"{own} {model}"),
        Step("zones", t("gold", "delivery_zones"), ("zones_in",), zones),
        Step("surcharge_config", t("gold", "surcharge_config"), ("config_in",), config),
    ]


def refresh_all(spark: SparkSession, inputs: RefreshInputs, cfg: Config = DEFAULT,
                as_of=None, model: str = "additive", check_pages: bool = True,
                ledger: str | None = None) -> dict[str, int]:
    """Run bronze -> silver -> gold -> forecast -> zones/config -> view.

    Returns the row count of every written table (observed during the
    write).  ``model`` picks the forecast: ``additive`` or ``linear_seasonal``.
    With ``check_pages`` a page set holding fewer records than it declares
    stops the run before anything is written.  Tables may gain and widen
    columns; only the zones, which an owner supplies, may change freely.  Silver is partitioned by
    product, so product filters of later reads prune files.

    With ``ledger``, a folder, a run goes on where an earlier one failed, and
    only the steps behind a changed input run again (see ``plans.ledger``).
    That takes one scan of each outside input for its version.
    """
    tb.ensure_namespaces(spark, cfg)
    steps = refresh_steps(spark, inputs, cfg, as_of, model, check_pages)
    if ledger is None:
        counts = {step.name: step.run() for step in steps}
    else:
        source = inputs.records if inputs.pages_path is None else pg.read_pages(spark, inputs.pages_path)
        config = inputs.surcharge_config or tb.surcharge_config_frame(spark)
        counts = StepLedger(spark, ledger).run(steps, {
            "source": content_version(source), "zones_in": content_version(inputs.zones),
            "config_in": content_version(config)})
    spark.sql(margin_view_sql(cfg))
    return counts
