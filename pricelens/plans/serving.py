"""Reads served from the written gold tables (what the reference's data
routes return), built from the same operators as the registered queries.

Run ``refresh_all`` first; every function takes the session and the config
(catalog prefix) and returns a typed DataFrame.  Product codes are checked
against the ingested set and week counts clamped to 1..520, as parameters,
never spliced into SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.config import DEFAULT, FORECAST_WINDOW_DAYS, Config
from pricelens.operators import forecast as fc
from pricelens.operators import margins as mg
from pricelens.operators import reads as rd


def _gold(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    return spark.table(cfg.table("gold", name))


def snapshot(spark: SparkSession, cfg: Config = DEFAULT) -> DataFrame:
    """Latest week of the national summary (table-wide latest date)."""
    return rd.snapshot(_gold(spark, cfg, "weekly_fuel_summary"))


def trends(spark: SparkSession, product: str = "EPMR", weeks=52, cfg: Config = DEFAULT) -> DataFrame:
    """Newest ``weeks`` rows of one product, oldest first."""
    return rd.trends(_gold(spark, cfg, "weekly_fuel_summary"), product, weeks, cfg)


def regional(spark: SparkSession, product: str = DEFAULT.diesel_product,
             cfg: Config = DEFAULT) -> DataFrame:
    """Areas at the product's latest date, national row excluded, dearest first."""
    return rd.regional_latest(_gold(spark, cfg, "regional_comparison"), product, cfg)


def forecast(spark: SparkSession, product: str = "EPMR", as_of=None,
             cfg: Config = DEFAULT) -> DataFrame:
    """Actuals and forecast of one product from 180 days before ``as_of``
    (default today), with the bridge row that joins the two lines."""
    rd.validate_product(product, cfg)
    window = fc.forecast_window(_gold(spark, cfg, "fuel_price_forecast"), product, as_of,
                                FORECAST_WINDOW_DAYS)
    return fc.forecast_bridge(window).orderBy("price_date")


def products(spark: SparkSession, cfg: Config = DEFAULT) -> DataFrame:
    """Distinct products of the weekly summary."""
    return rd.products(_gold(spark, cfg, "weekly_fuel_summary"))


def margins(spark: SparkSession, cfg: Config = DEFAULT) -> DataFrame:
    """The delivery margin view, worst margin first, with status."""
    return mg.margin_status(mg.margins_by_pct(_gold(spark, cfg, "delivery_margins")))


def surcharge_config(spark: SparkSession, cfg: Config = DEFAULT) -> DataFrame:
    """The stored surcharge configuration."""
    return _gold(spark, cfg, "surcharge_config")
