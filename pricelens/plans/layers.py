"""Lazily built layers over one driver-table directory.

``Layers(spark, sf_dir)`` exposes records -> bronze -> silver -> gold as
DataFrames (plans, not data).  Registered queries are thin reads on top, so
Catalyst sees each whole query at once and prunes / pushes down through
the layers.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pricelens.config import DEFAULT, Config
from pricelens.operators import margins, series, silver
from pricelens.session import materialize
from pricelens.sources import adapter, pages


class Layers:
    """Layer plans over one table directory.

    Nothing is kept between calls: every query plans from the current files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT, as_of=None,
                 products: tuple[str, ...] | None = None):
        """``products``: source-side product facet (default: the ingested
        set); a query that only needs some products reads only those."""
        self.products = tuple(products) if products is not None else tuple(cfg.ingest_products)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.cfg = cfg
        self.as_of = as_of

    @cached_property
    def records(self) -> DataFrame:
        return adapter.price_records(self.spark, self.sf_dir, self.products)

    @cached_property
    def bronze(self) -> DataFrame:
        # records come from one aggregation (unique keys): no page overlap
        return pages.bronze_records(self.records, self.cfg, self.as_of, dedupe=False)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.silver_prices(self.bronze, self.cfg)

    @cached_property
    def weekly(self) -> DataFrame:
        return series.weekly_summary(self.silver, self.cfg)

    @cached_property
    def regional(self) -> DataFrame:
        return series.regional_comparison(self.silver, self.cfg)

    @cached_property
    def zones(self) -> DataFrame:
        return adapter.delivery_zones(self.spark, self.sf_dir)

    @cached_property
    def zone_states(self) -> DataFrame:
        return adapter.zone_states(self.spark, self.sf_dir)

    @cached_property
    def margins(self) -> DataFrame:
        return margins.delivery_margins(self.regional_newest, self.zones, self.cfg)

    @cached_property
    def weekly_newest(self) -> DataFrame:
        """The weekly summary of the newest week of each series only (the
        windows run over 12 rows per series, not the whole history)."""
        return series.weekly_summary(self.silver, self.cfg, newest=1)

    @cached_property
    def regional_newest(self) -> DataFrame:
        """Regional rows of the newest date of each (product, area) series;
        every "latest" read (per product or table-wide) lies within them."""
        return series.regional_comparison(self.silver, self.cfg, newest=1)

    @cached_property
    def records_materialized(self) -> DataFrame:
        """The raw records computed once (they are an aggregate: small).
        Plans that read them more than once, e.g. through a scalar subquery
        for a total or a newest date, then never rescan the line items."""
        return materialize(self.records)
