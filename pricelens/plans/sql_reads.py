"""Parametrised reads as SQL table functions (P-13 with B-07, B-10, B-15).

``register_sql_reads`` defines temporary functions over the named relations:

* ``price_trends(wanted, weeks)``: newest rows of a product, weeks clamped;
* ``price_regional(wanted)``: areas at the product's latest date;
* ``price_forecast(wanted, as_of, days)``: one product around ``as_of``;
* ``price_forecast_latest(wanted, days)``: the same around its newest actual.

Callers bind values: ``spark.sql("SELECT * FROM price_trends(:p, :n)",
args={"p": "EPMR", "n": 52})``.  Each function is inlined into the query, so
the product reaches the scan as a pushed filter.  An unknown or null product
is an error once a row is read, and so is a null number of weeks or days.
Table functions promise no order.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pricelens.config import DEFAULT, DEFAULT_TREND_WEEKS, FORECAST_WINDOW_DAYS, Config

TREND_COLUMNS = ("price_date DATE, price_per_gallon DOUBLE, wow_change DOUBLE, wow_pct_change DOUBLE, "
                 "avg_4wk DOUBLE, avg_12wk DOUBLE")
REGIONAL_COLUMNS = ("area_name STRING, duoarea STRING, price_per_gallon DOUBLE, wow_change DOUBLE, "
                    "price_date DATE, product STRING")
FORECAST_READ_COLUMNS = ("price_date DATE, actual_price DOUBLE, forecast_price DOUBLE, forecast_lower DOUBLE, "
                         "forecast_upper DOUBLE, is_forecast BOOLEAN, product_name STRING, product STRING")


def _names(columns: str) -> str:
    return ", ".join(c.split()[0] for c in columns.split(", "))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _known(cfg: Config) -> str:
    tracked = ", ".join(_text(p) for p in cfg.ingest_products)
    return (f"CASE WHEN wanted IN ({tracked}) THEN wanted "
            "ELSE raise_error(concat('unknown product: ', coalesce(wanted, 'null'))) END")


def _given(name: str) -> str:
    return f"coalesce({name}, raise_error('{name} is null'))"


def register_sql_reads(spark: SparkSession, weekly: str | None = None, regional: str | None = None,
                       forecast: str | None = None, cfg: Config = DEFAULT) -> None:
    """Define the functions whose relation is named; by default the gold tables."""
    if weekly is None and regional is None and forecast is None:
        weekly, regional, forecast = (cfg.table("gold", t) for t in (
            "weekly_fuel_summary", "regional_comparison", "fuel_price_forecast"))

    def define(signature: str, columns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")

    if weekly:
        define(f"price_trends(wanted STRING, weeks INT DEFAULT {DEFAULT_TREND_WEEKS})", TREND_COLUMNS, f"""
            SELECT {_names(TREND_COLUMNS)} FROM (
              SELECT *, row_number() OVER (PARTITION BY product ORDER BY price_date DESC) AS newest
              FROM {weekly} WHERE product = {_known(cfg)})
            WHERE newest <= greatest(1, least({_given('weeks')}, {cfg.max_trend_weeks}))""")
    if regional:
        define("price_regional(wanted STRING)", REGIONAL_COLUMNS, f"""
            SELECT {_names(REGIONAL_COLUMNS)} FROM (
              SELECT *, rank() OVER (PARTITION BY product ORDER BY price_date DESC) AS newest
              FROM {regional} WHERE product = {_known(cfg)})
            WHERE newest = 1 AND price_date IS NOT NULL AND area_name <> {_text(cfg.national_area)}""")
    if forecast:
        define(f"price_forecast(wanted STRING, as_of DATE, days INT DEFAULT {FORECAST_WINDOW_DAYS})",
               FORECAST_READ_COLUMNS, f"""
            SELECT {_names(FORECAST_READ_COLUMNS)} FROM {forecast}
            WHERE product = {_known(cfg)}
              AND price_date >= date_sub(coalesce(as_of, current_date()), {_given('days')})""")
        define(f"price_forecast_latest(wanted STRING, days INT DEFAULT {FORECAST_WINDOW_DAYS})",
               FORECAST_READ_COLUMNS, f"""
            SELECT {_names(FORECAST_READ_COLUMNS)} FROM (
              SELECT *, max(CASE WHEN actual_price IS NOT NULL THEN price_date END) OVER (PARTITION BY product) AS anchor
              FROM {forecast} WHERE product = {_known(cfg)})
            WHERE price_date >= date_sub(anchor, {_given('days')})""")
