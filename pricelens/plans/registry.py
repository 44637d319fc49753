"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query builds its layers from the driver tables in ``sf_dir`` and runs
one library operator on top over the whole tables; nothing is collected.
Where a read needs "today" (forecast windows), the data's own newest actual
date is used, as a scalar subquery, since the test data ends years ago.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.config import (
    DEFAULT,
    DEFAULT_TREND_WEEKS,
    PREVIEW_ROWS,
    TEST_BASELINE_GRID_CENTS,
    TEST_LOAD_PAGE_SIZE,
    TEST_PAGES_PER_LOAD,
    UI_RATE,
)
from pricelens.functions.numeric import round_exact
from pricelens.operators import aggregated_fit as af
from pricelens.operators import forecast as fc
from pricelens.operators import margins as mg
from pricelens.operators import reads as rd
from pricelens.operators import series as sr
from pricelens.operators import silver as sv
from pricelens.operators import surcharge as sc
from pricelens.plans.layers import Layers
from pricelens.plans.incremental import GOLD, IncrementalLayers
from pricelens.plans.sql_reads import register_sql_reads
from pricelens.session import materialize, scratch_path
from pricelens.sources import loads as ld
from pricelens.sources import pages as pg
from pricelens.sources import tables as tb
from pricelens.sources.page_source import land_paged, register_page_source
from pricelens.sources.versions import VersionedTable

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}
UPSERT_KEYS = ["period", "product", "duoarea", "series"]
# The driver tables' newest diesel prices lie between about 2 and 15 dollars,
# mostly below the interactive baselines (3.00 to 6.00); the registered what-if
# reads use baselines below them, so that the surcharge arithmetic is exercised.
TEST_BASELINE = 1.00
TEST_RATE = UI_RATE


def register(name: str, scope: str | None = None):
    """Register a query; ``scope`` names the product facet it needs
    ("national", "regional", "forecast"), so the source reads only those."""
    def deco(fn: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            products = getattr(DEFAULT, f"{scope}_products") if scope else None
            return fn(Layers(spark, sf_dir, DEFAULT, products=products))
        _REGISTRY[name] = run
        return fn
    return deco


# --- sources and bronze -----------------------------------------------------

@register("paged_ingest")
def _paged_ingest(lay: Layers) -> DataFrame:
    """Records -> page documents (JSON text) -> parsed -> bronze rows."""
    texts = pg.records_to_pages(lay.records, lay.cfg.page_size).select(
        F.to_json(F.struct("response")).alias("value"))
    return pg.paged_ingest(pg.parse_page_text(texts), lay.cfg).drop("_ingested_at")


@register("page_report")
def _page_report(lay: Layers) -> DataFrame:
    return pg.page_report(pg.records_to_pages(lay.records, lay.cfg.page_size))


@register("load_report")
def _load_report(lay: Layers) -> DataFrame:
    """All records as loads of pages, with injected faults to report: in every
    third load the second page is lost, in every third the first comes twice."""
    pages = materialize(ld.records_to_load_pages(lay.records, TEST_LOAD_PAGE_SIZE, TEST_PAGES_PER_LOAD))
    load, first = F.col("load").cast("long"), F.col("offset") == "0"
    lost = (load % 3 == 1) & (F.col("offset") == str(TEST_LOAD_PAGE_SIZE))
    landed = pages.filter(~lost).unionByName(pages.filter((load % 3 == 2) & first))
    return ld.load_report(landed, TEST_LOAD_PAGE_SIZE)


@register("paged_source")
def _paged_source(lay: Layers) -> DataFrame:
    """Gasoline records of the newer half of the nineties, by the data source
    over landed pages, which drops the others at the page."""
    folder = _landed(lay, "paged")
    land_paged(ld.records_to_load_pages(lay.records, TEST_LOAD_PAGE_SIZE, TEST_PAGES_PER_LOAD), folder)
    register_page_source(lay.spark)
    rows = lay.spark.read.format("paged_records").options(path=folder, page_size=TEST_LOAD_PAGE_SIZE).load()
    return rows.filter(F.col("product").startswith("EPM") & (F.col("period") >= "1995-01-01"))


@register("ingest_profile")
def _ingest_profile(lay: Layers) -> DataFrame:
    return rd.ingest_profile(lay.bronze)


@register("keyed_upsert")
def _keyed_upsert(lay: Layers) -> DataFrame:
    """A first load, then a re-landing of the newest 7 weeks with revised
    values; per key the later load wins."""
    first = pg.bronze_records(lay.records_materialized, lay.cfg, as_of="2026-01-01", dedupe=False)
    pdate = F.col("period").try_cast("date")
    newest = first.agg(F.max(pdate)).scalar()
    revised = round_exact(F.col("value").try_cast("double") + F.lit(0.01), 3)
    updates = (first.filter(pdate >= F.date_sub(newest, 42))
               .withColumns({"value": revised.cast("decimal(10,3)").cast("string"),
                             "_ingested_at": F.lit("2026-01-08 00:00:00").cast("timestamp")}))
    merged = tb.keyed_upsert(first, updates, UPSERT_KEYS)
    return merged.withColumn("_ingested_at", F.col("_ingested_at").cast("string"))


def _first_and_update(lay: Layers) -> tuple[DataFrame, DataFrame]:
    """Raw records as a first load and an update: the update revises the
    newest 7 weeks and brings the oldest 10 weeks, which come late."""
    records = lay.records_materialized
    pdate = F.col("period").try_cast("date")
    ends = records.agg(F.min(pdate).alias("lo"), F.max(pdate).alias("hi"))
    late = pdate < F.date_add(ends.select("lo").scalar(), 70)
    revised = round_exact(F.col("value").try_cast("double") + F.lit(0.01), 3).cast("decimal(10,3)").cast("string")
    new = records.filter(pdate >= F.date_sub(ends.select("hi").scalar(), 42)).withColumn("value", revised)
    return records.filter(~late), new.unionByName(records.filter(late))


def _landed(lay: Layers, name: str) -> str:
    return scratch_path(lay.spark, f"{name}-{uuid.uuid4().hex}")


@register("versioned_merge")
def _versioned_merge(lay: Layers) -> DataFrame:
    """A versioned bronze table after a first load and an update, which comes
    twice under one batch number."""
    table = VersionedTable(lay.spark, _landed(lay, "versioned"), "period")
    first, update = _first_and_update(lay)
    table.merge(pg.bronze_records(first, lay.cfg, "2026-01-01", dedupe=False), UPSERT_KEYS, batch=("load", 0))
    for _ in range(2):
        table.merge(pg.bronze_records(update, lay.cfg, "2026-01-08", dedupe=False), UPSERT_KEYS, batch=("load", 1))
    return table.read().withColumn("_ingested_at", F.col("_ingested_at").cast("string"))


def _incremental(lay: Layers, name: str) -> DataFrame:
    layers = IncrementalLayers(lay.spark, _landed(lay, "incremental"), lay.cfg, gold={name: GOLD[name]})
    for batch, records in enumerate(_first_and_update(lay)):
        layers.load(records, batch, as_of=f"2026-01-{1 + 7 * batch:02d}")
    return layers.read(name)


@register("incremental_weekly", "national")
def _incremental_weekly(lay: Layers) -> DataFrame:
    """The weekly summary after a first load and an update of revised and late
    records, only the touched blocks rewritten."""
    return _incremental(lay, "weekly")


@register("incremental_regional", "regional")
def _incremental_regional(lay: Layers) -> DataFrame:
    return _incremental(lay, "regional")


# --- silver -------------------------------------------------------------------

@register("silver_prices")
def _silver(lay: Layers) -> DataFrame:
    return lay.silver


@register("silver_rejects")
def _silver_rejects(lay: Layers) -> DataFrame:
    return sv.silver_rejects(lay.bronze, lay.cfg)


@register("silver_preview", "regional")
def _silver_preview(lay: Layers) -> DataFrame:
    return rd.silver_preview(lay.silver, lay.cfg)


@register("duplicate_keys")
def _duplicate_keys(lay: Layers) -> DataFrame:
    return sr.duplicate_keys(lay.silver, ["product", "duoarea", "series"])


# --- gold series ------------------------------------------------------------

@register("weekly_summary", "national")
def _weekly(lay: Layers) -> DataFrame:
    return lay.weekly


@register("regional_comparison", "regional")
def _regional(lay: Layers) -> DataFrame:
    return lay.regional


@register("weekly_summary_blocked", "national")
def _weekly_blocked(lay: Layers) -> DataFrame:
    return sr.weekly_summary_blocked(lay.silver, lay.cfg)


@register("regional_comparison_blocked", "regional")
def _regional_blocked(lay: Layers) -> DataFrame:
    return sr.regional_comparison_blocked(lay.silver, lay.cfg)


@register("weekly_preview", "national")
def _weekly_preview(lay: Layers) -> DataFrame:
    # the newest 20 rows overall lie within each series' newest 20 dates
    return rd.weekly_preview(sr.weekly_summary(lay.silver, lay.cfg, newest=PREVIEW_ROWS))


# --- reads ----------------------------------------------------------------------

@register("snapshot", "national")
def _snapshot(lay: Layers) -> DataFrame:
    # the table-wide latest date is among the newest rows of the series
    return rd.snapshot(lay.weekly_newest)


@register("snapshot_cards", "national")
def _snapshot_cards(lay: Layers) -> DataFrame:
    return rd.snapshot_cards(rd.snapshot(lay.weekly_newest), lay.cfg)


@register("trends", "national")
def _trends(lay: Layers) -> DataFrame:
    weekly = sr.weekly_summary(lay.silver, lay.cfg, newest=rd.clamp_weeks(DEFAULT_TREND_WEEKS))
    return rd.trends(weekly, "EPMR", DEFAULT_TREND_WEEKS, lay.cfg)


@register("trends_all", "national")
def _trends_all(lay: Layers) -> DataFrame:
    weekly = sr.weekly_summary(lay.silver, lay.cfg, newest=rd.clamp_weeks(DEFAULT_TREND_WEEKS))
    return rd.trends_per_product(weekly, DEFAULT_TREND_WEEKS, lay.cfg)


@register("data_through", "national")
def _data_through(lay: Layers) -> DataFrame:
    return rd.data_through(lay.weekly)


@register("products", "national")
def _products(lay: Layers) -> DataFrame:
    return rd.products(lay.weekly)


@register("regional_latest", "regional")
def _regional_latest(lay: Layers) -> DataFrame:
    return rd.regional_latest(lay.regional_newest, lay.cfg.diesel_product, lay.cfg)


@register("regional_latest_global", "regional")
def _regional_latest_global(lay: Layers) -> DataFrame:
    return rd.regional_latest_global(lay.regional_newest, lay.cfg.diesel_product)


@register("regional_position", "regional")
def _regional_position(lay: Layers) -> DataFrame:
    return rd.regional_position(rd.regional_latest_each(lay.regional_newest, None, lay.cfg))


# --- margins ------------------------------------------------------------------

def _margins(lay: Layers) -> DataFrame:
    return lay.margins


@register("delivery_margins", "regional")
def _delivery_margins(lay: Layers) -> DataFrame:
    return mg.margins_by_pct(_margins(lay))


@register("margin_status", "regional")
def _margin_status(lay: Layers) -> DataFrame:
    return mg.margin_status(_margins(lay)).select("duoarea", "zone_name", "margin_pct", "status",
                                                  "marker_radius")


@register("fleet_totals", "regional")
def _fleet_totals(lay: Layers) -> DataFrame:
    return mg.fleet_totals(mg.margin_status(_margins(lay)))


@register("state_rollup", "regional")
def _state_rollup(lay: Layers) -> DataFrame:
    return mg.state_rollup(mg.margin_status(_margins(lay)), mg.state_bridge(lay.zone_states))


# --- surcharge ------------------------------------------------------------------

def _diesel_latest(lay: Layers) -> DataFrame:
    return rd.regional_latest(lay.regional_newest, lay.cfg.diesel_product, lay.cfg)


@register("fleet_parameters")
def _fleet_parameters(lay: Layers) -> DataFrame:
    fleet = sc.fleet_from_zones(lay.zones)
    return fleet.select("*", round_exact(sc.break_even_rate("gallons_per_delivery"), 6)
                        .alias("break_even_rate"))


@register("surcharge_point", "regional")
def _surcharge_point(lay: Layers) -> DataFrame:
    return sc.surcharge_point(_diesel_latest(lay), TEST_BASELINE, TEST_RATE, lay.cfg.fleet)


@register("surcharge_scenarios", "regional")
def _surcharge_scenarios(lay: Layers) -> DataFrame:
    return sc.surcharge_scenarios(_diesel_latest(lay), lay.cfg.fleet,
                                  baseline_cents=TEST_BASELINE_GRID_CENTS)


# --- forecasts ------------------------------------------------------------------

def _baseline(lay: Layers) -> DataFrame:
    return fc.linear_seasonal_forecast(lay.weekly, lay.cfg)


@register("future_weeks", "forecast")
def _future_weeks(lay: Layers) -> DataFrame:
    return fc.future_dates(lay.weekly, lay.cfg)


@register("forecast_linear_seasonal", "forecast")
def _forecast_linear(lay: Layers) -> DataFrame:
    return _baseline(lay)


@register("forecast_additive", "forecast")
def _forecast_additive(lay: Layers) -> DataFrame:
    return fc.additive_forecast(lay.weekly, lay.cfg)


@register("forecast_future", "forecast")
def _forecast_future(lay: Layers) -> DataFrame:
    return fc.forecast_future(_baseline(lay))


@register("forecast_recent", "forecast")
def _forecast_recent(lay: Layers) -> DataFrame:
    return fc.forecast_recent(_baseline(lay), fc.LATEST_ACTUAL)


def _diesel_window(lay: Layers) -> DataFrame:
    return fc.forecast_window(_baseline(lay), lay.cfg.diesel_product, fc.LATEST_ACTUAL)


@register("forecast_window", "forecast")
def _forecast_window(lay: Layers) -> DataFrame:
    return _diesel_window(lay)


@register("forecast_bridge", "forecast")
def _forecast_bridge(lay: Layers) -> DataFrame:
    return fc.forecast_bridge(_diesel_window(lay))


@register("surcharge_series", "forecast")
def _surcharge_series(lay: Layers) -> DataFrame:
    return sc.surcharge_series(fc.forecast_bridge(_diesel_window(lay)), TEST_BASELINE, TEST_RATE,
                               lay.cfg.fleet)


@register("surcharge_series_grid", "forecast")
def _surcharge_series_grid(lay: Layers) -> DataFrame:
    return sc.surcharge_series_grid(fc.forecast_bridge(_diesel_window(lay)), lay.cfg.fleet,
                                    baseline_cents=TEST_BASELINE_GRID_CENTS)


@register("surcharge_totals", "forecast")
def _surcharge_totals(lay: Layers) -> DataFrame:
    """Totals of every scenario over the whole series, history and horizon."""
    return sc.scenario_totals(_baseline(lay), lay.cfg.fleet, baseline_cents=TEST_BASELINE_GRID_CENTS)


# --- model fitted by aggregation ---------------------------------------------

@register("forecast_gram", "forecast")
def _forecast_gram(lay: Layers) -> DataFrame:
    """Exact sums behind the aggregated fit, per series and feature pair."""
    hist = materialize(af.dated_history(lay.weekly, lay.cfg))
    sums = af.gram_sums(hist, af.series_frame(hist))
    return sums.withColumn("total", F.col("total").cast("string"))


@register("forecast_aggregated", "forecast")
def _forecast_aggregated(lay: Layers) -> DataFrame:
    return af.aggregated_forecast(lay.weekly, lay.cfg)


@register("forecast_simulated", "forecast")
def _forecast_simulated(lay: Layers) -> DataFrame:
    return af.aggregated_forecast(lay.weekly, lay.cfg, simulate=True)


# --- SQL table functions -------------------------------------------------------

def _view(rows: DataFrame) -> str:
    name = f"reads_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(name)
    return name


@register("trends_sql", "national")
def _trends_sql(lay: Layers) -> DataFrame:
    register_sql_reads(lay.spark, weekly=_view(lay.weekly), cfg=lay.cfg)
    return lay.spark.sql("SELECT * FROM price_trends(:product, :weeks)",
                         args={"product": "EPMR", "weeks": DEFAULT_TREND_WEEKS})


@register("regional_sql", "regional")
def _regional_sql(lay: Layers) -> DataFrame:
    register_sql_reads(lay.spark, regional=_view(lay.regional), cfg=lay.cfg)
    return lay.spark.sql("SELECT * FROM price_regional(:product)", args={"product": lay.cfg.diesel_product})


@register("forecast_window_sql", "forecast")
def _forecast_window_sql(lay: Layers) -> DataFrame:
    register_sql_reads(lay.spark, forecast=_view(_baseline(lay)), cfg=lay.cfg)
    return lay.spark.sql("SELECT * FROM price_forecast_latest(:product)", args={"product": lay.cfg.diesel_product})


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)
