"""Merges keep every period; one row per key; the latest slice and the bands."""

import datetime as dt
import os
import shutil

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.functions.numeric import exact_sum, round_exact
from pricelens.operators import series
from pricelens.operators.silver import silver_prices
from pricelens.plans.refresh import RefreshInputs, refresh_all
from pricelens.plans.registry import all_queries
from pricelens.sources import adapter, pages
from pricelens.sources import tables as tb
from pricelens.streaming import stream_pages_to_bronze

from conftest import SF_ORACLE, SF_SMALL
from helpers import silver_df, silver_rows

KEY = ["period", "product", "duoarea", "series"]


def test_stream_after_refresh_equals_a_full_load(spark, tmp_dir):
    cfg = Config(catalog="t_inc")
    records = adapter.price_records(spark, SF_SMALL)
    refresh_all(spark, RefreshInputs(records=records, zones=adapter.delivery_zones(spark, SF_SMALL)), cfg,
                model="linear_seasonal")
    table = cfg.table("bronze", "fuel_prices_raw")
    before = spark.table(table).drop("_ingested_at")
    want = {tuple(r) for r in before.select(*sorted(before.columns)).collect()}
    newest = sorted({r.period for r in records.select("period").distinct().collect()})[-3:]
    landing = os.path.join(tmp_dir, "landing")
    pages.land_pages(pages.records_to_pages(records.filter(F.col("period").isin(newest))), landing)
    q = stream_pages_to_bronze(spark, landing, cfg, checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    assert q.exception() is None
    spark.catalog.refreshTable(table)
    after = spark.table(table).drop("_ingested_at")
    assert {tuple(r) for r in after.select(*sorted(after.columns)).collect()} == want
    assert after.groupBy(*KEY).count().filter("count > 1").count() == 0


def test_first_batch_is_merged_by_key_and_other_layouts_are_refused(spark):
    tb.ensure_namespaces(spark)
    rows = spark.createDataFrame([("2024-01-01", "a", "1", 1), ("2024-01-01", "a", "2", 2),
                                  ("2024-01-08", "a", "3", 1)], "period string, k string, value string, _ingested_at int")
    assert tb.merge_partitions(rows, "bronze.t_first", ["period", "k"], "period") == 2
    assert tb.merge_partitions(rows, "bronze.t_first", ["period", "k"], "period") == 2
    got = {(r.period, r.value) for r in spark.table("bronze.t_first").collect()}
    assert got == {("2024-01-01", "2"), ("2024-01-08", "3")}
    tb.write_table(rows, "bronze.t_flat", evolve=True)
    with pytest.raises(ValueError):
        tb.merge_partitions(rows, "bronze.t_flat", ["period", "k"], "period")
    assert spark.table("bronze.t_flat").count() == 3


def test_a_truncated_page_stops_the_stream(spark, tmp_dir):
    cfg = Config(catalog="t_cut")
    landing = os.path.join(tmp_dir, "landing_cut")
    pages.land_pages(pages.records_to_pages(adapter.price_records(spark, SF_SMALL), 2000), landing)
    part = sorted(f for f in os.listdir(landing) if f.startswith("part-") and os.path.getsize(f"{landing}/{f}"))[0]
    with open(f"{landing}/cut.json", "w") as f:
        f.write(open(f"{landing}/{part}").readline()[:500])
    q = stream_pages_to_bronze(spark, landing, cfg, checkpoint=os.path.join(tmp_dir, "ck_cut"))
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    assert not spark.catalog.tableExists(cfg.table("bronze", "fuel_prices_raw"))
    with pytest.raises(ValueError):
        pages.require_complete(pages.read_pages(spark, landing))


def test_latest_is_one_pass_and_ignores_missing_dates(spark):
    df = silver_df(spark, silver_rows("EPMR", [1.0, 2.0]) + silver_rows("EPMP", [5.0]))
    assert {r.price_per_gallon for r in series.latest(df).collect()} == {2.0}
    assert {r.price_per_gallon for r in series.latest(df, ["product"]).collect()} == {2.0, 5.0}
    undated = df.withColumn("price_date", F.lit(None).cast("date"))
    assert series.latest(undated).count() == 0
    plan = series.latest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "WindowGroupLimit" in plan


def test_undatable_rows_stay_out_of_silver(spark):
    raw = pages.bronze_records(adapter.price_records(spark, SF_SMALL), Config())
    bad = raw.limit(3).withColumns({"period": F.lit("soon"), "value": F.lit("1.0")})
    assert silver_prices(raw.unionByName(bad)).filter("price_date is null").count() == 0


def test_all_bands_occur(spark):
    got = all_queries()["surcharge_scenarios"](spark, SF_ORACLE).select("recovery_band").distinct().collect()
    assert {r[0] for r in got} == {"good", "partial", "poor", None}
    s = all_queries()["surcharge_series"](spark, SF_ORACLE)
    assert s.filter("surcharge_revenue > 0").count() > 0.5 * s.count()


def test_large_values_are_kept(spark):
    df = spark.createDataFrame([(1e16,), (2.0,)], "x double")
    assert float(df.agg(exact_sum("x")).first()[0]) == 1e16 + 2
    assert df.select(round_exact("x", 2).alias("x")).agg(F.max("x")).first()[0] == 1e16


def test_queries_see_new_files(spark, tmp_dir):
    for t in ("nation", "region", "supplier", "part", "orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    first = all_queries()["data_through"](spark, tmp_dir).first()[0]
    lines = pq.read_table(f"{SF_SMALL}/lineitem.parquet")
    cut = dt.datetime(1996, 1, 1)
    pq.write_table(lines.filter(pc.less(lines["l_shipdate"].cast("timestamp[us]"), cut)), f"{tmp_dir}/lineitem.parquet")
    spark.catalog.refreshByPath(tmp_dir)
    assert all_queries()["data_through"](spark, tmp_dir).first()[0] < first
