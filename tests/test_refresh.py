import os

from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.operators import margins as mg
from pricelens.plans.refresh import RefreshInputs, refresh_all
from pricelens.sources import adapter, pages
from pricelens.streaming import stream_pages_to_bronze

from conftest import SF_SMALL


def test_refresh_writes_all_layers_and_is_idempotent(spark):
    cfg = Config(catalog="t1")
    inputs = RefreshInputs(records=adapter.price_records(spark, SF_SMALL),
                           zones=adapter.delivery_zones(spark, SF_SMALL))
    first = refresh_all(spark, inputs, cfg, as_of="2026-01-01", model="linear_seasonal")
    assert set(first) == {"bronze", "silver", "weekly", "regional", "forecast", "zones", "surcharge_config"}
    assert all(v > 0 for v in first.values())
    second = refresh_all(spark, inputs, cfg, as_of="2026-01-01", model="linear_seasonal")
    assert first == second
    weekly = spark.table(cfg.table("gold", "weekly_fuel_summary"))
    assert weekly.count() == first["weekly"]
    # the persistent view equals the DataFrame operator
    view = spark.table(cfg.table("gold", "delivery_margins"))
    op = mg.delivery_margins(spark.table(cfg.table("gold", "regional_comparison")),
                             spark.table(cfg.table("gold", "delivery_zones")), cfg)
    assert view.count() > 0
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, op.select(*view.columns).collect()))
    # the served reads over the written tables
    from pricelens.plans import serving
    snap = serving.snapshot(spark, cfg).collect()
    assert len(snap) == 4 and len({r.price_date for r in snap}) == 1
    assert serving.trends(spark, "EPMR", 10_000, cfg).count() == weekly.filter("product = 'EPMR'").count()
    reg = serving.regional(spark, "EPD2DXL0", cfg).collect()
    assert reg and all(r.area_name != "U.S." for r in reg)
    last = spark.table(cfg.table("gold", "fuel_price_forecast")).filter(
        "product = 'EPMR' AND actual_price IS NOT NULL").agg({"price_date": "max"}).first()[0]
    fcst = serving.forecast(spark, "EPMR", as_of=last, cfg=cfg).collect()
    assert sum(r.is_forecast for r in fcst) == 8
    assert serving.products(spark, cfg).count() == 4
    m = serving.margins(spark, cfg).collect()
    assert [r.margin_pct for r in m] == sorted(r.margin_pct for r in m)
    assert serving.surcharge_config(spark, cfg).count() == 1


def test_refresh_from_landed_pages(spark, tmp_dir):
    cfg = Config(catalog="t2")
    landed = os.path.join(tmp_dir, "pages")
    pages.land_pages(pages.records_to_pages(adapter.price_records(spark, SF_SMALL)), landed)
    counts = refresh_all(spark, RefreshInputs(pages_path=landed,
                                              zones=adapter.delivery_zones(spark, SF_SMALL)),
                         cfg, as_of="2026-01-01", model="additive")
    direct = pages.bronze_records(adapter.price_records(spark, SF_SMALL), cfg).count()
    assert counts["bronze"] == direct


def test_stream_merges_new_pages(spark, tmp_dir):
    cfg = Config(catalog="t3")
    recs = adapter.price_records(spark, SF_SMALL)
    landing = os.path.join(tmp_dir, "landing")
    table = cfg.table("bronze", "fuel_prices_raw")
    older = recs.filter("period < '1997-01-01'")
    pages.land_pages(pages.records_to_pages(older), os.path.join(landing, "a"))
    q = stream_pages_to_bronze(spark, landing + "/*", cfg, table=table,
                               checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    n1 = spark.table(table).count()
    assert n1 == pages.bronze_records(older, cfg).count()
    # a second landing revises one value and adds the rest
    revised = recs.withColumn("value", F.when(F.col("period") == "1995-01-02", F.lit("9.999"))
                              .otherwise(F.col("value")))
    pages.land_pages(pages.records_to_pages(revised), os.path.join(landing, "b"))
    q = stream_pages_to_bronze(spark, landing + "/*", cfg, table=table,
                               checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    spark.catalog.refreshTable(table)  # the stream swapped the table's files
    out = spark.table(table)
    assert out.count() == pages.bronze_records(recs, cfg).count()
    vals = {r.value for r in out.filter("period = '1995-01-02'").collect()}
    assert vals == {"9.999"}
