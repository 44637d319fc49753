import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pricelens.sources import pages as pg
from pricelens.sources import tables as tb
from pricelens.sources.adapter import RECORD_FIELDS


def rec(period, product, value, duoarea="NUS"):
    return {"period": period, "duoarea": duoarea, "area-name": "U.S.", "product": product,
            "product-name": f"n {product}", "process-name": "Retail", "series": f"{product}_{duoarea}",
            "series-description": "d", "value": value, "units": "$/GAL"}


def write_pages(path, pages, multi=False):
    os.makedirs(path, exist_ok=True)
    for i, (total, data) in enumerate(pages):
        doc = {"response": {"total": total, "data": data}}
        with open(os.path.join(path, f"page-{i}.json"), "w") as fh:
            fh.write(json.dumps(doc, indent=2 if multi else None) + "\n")


def test_page_round_trip_overlap_and_report(spark, tmp_dir):
    r1 = [rec("2024-01-08", "EPMR", "3.1"), rec("2024-01-08", "EPD2D", "4.0")]
    r2 = [rec("2024-01-08", "EPD2D", "4.0"),  # overlaps page 1
          dict(rec("2024-01-01", "EPMR", "3.0"), extra="ignored"),
          rec("2024-01-01", "EPLLPA", "1.0")]  # untracked product
    write_pages(tmp_dir, [("6", r1), (6, r2), ("6", [])], multi=True)
    pages = pg.read_pages(spark, tmp_dir, multi_line=True)
    rep = pg.page_report(pages).first()
    assert (rep.pages, rep.declared_total, rep.records_found, rep.distinct_records, rep.missing) == (3, 6, 5, 4, 2)
    bronze = pg.paged_ingest(pages, as_of="2024-02-01").collect()
    assert sorted((r.period, r.product) for r in bronze) == [
        ("2024-01-01", "EPMR"), ("2024-01-08", "EPD2D"), ("2024-01-08", "EPMR")]
    assert {r._source for r in bronze} == {"price_api_v2"}
    assert {r._ingested_at for r in bronze} == {dt.datetime(2024, 2, 1)}


def test_records_to_pages_and_back(spark, tmp_dir):
    recs = spark.createDataFrame([tuple(rec(f"2024-01-{d:02d}", p, str(d)).values())
                                  for d in range(1, 29) for p in ("EPMR", "EPD2D")],
                                 pg.RECORD_SCHEMA)
    pages = pg.records_to_pages(recs, page_size=10)
    sizes = sorted(r.n for r in pages.select(F.size("response.data").alias("n")).collect())
    assert sum(sizes) == 56 and len(sizes) <= 6
    out = os.path.join(tmp_dir, "landed")
    pg.land_pages(pages, out)
    back = pg.flatten_pages(pg.read_pages(spark, out))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, recs.collect()))
    assert tuple(back.columns) == RECORD_FIELDS


def test_page_offsets_plan():
    pass


def test_page_offsets(spark):
    got = [(r.page, r.offset, r.length) for r in pg.page_offsets(spark, 12001, 5000).collect()]
    assert got == [(0, 0, 5000), (1, 5000, 5000), (2, 10000, 2001)]


def test_keyed_upsert_latest_wins(spark):
    cols = "k string, v string, _ingested_at timestamp"
    cur = spark.createDataFrame([("a", "1", dt.datetime(2024, 1, 1)), ("b", "1", dt.datetime(2024, 1, 1))], cols)
    upd = spark.createDataFrame([("a", "2", dt.datetime(2024, 1, 2)), ("c", "1", dt.datetime(2024, 1, 2)),
                                 ("b", "0", dt.datetime(2023, 12, 1))], cols)
    got = sorted(map(tuple, tb.keyed_upsert(cur, upd, ["k"]).collect()))
    assert got == [("a", "2", dt.datetime(2024, 1, 2)), ("b", "1", dt.datetime(2024, 1, 1)),
                   ("c", "1", dt.datetime(2024, 1, 2))]
    plan = tb.keyed_upsert(cur, upd, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # one aggregation, no window over a key


def test_write_table_counts_and_schema_guard(spark):
    tb.ensure_namespaces(spark)
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert tb.write_table(df, "bronze.t_guard") == 2
    assert tb.write_table(df, "bronze.t_guard") == 2  # idempotent overwrite
    with pytest.raises(ValueError):
        tb.write_table(df.withColumn("c", F.lit(1)), "bronze.t_guard")
    assert tb.write_table(df.withColumn("c", F.lit(1)), "bronze.t_guard", evolve=True) == 2


def test_surcharge_config_and_zone_contract(spark):
    c = tb.surcharge_config_frame(spark).first()
    assert (c.baseline_fuel_price, c.surcharge_rate, c.last_calibrated) == (4.5, 0.08, "2026-01-15")
    with pytest.raises(ValueError):
        tb.require_zone_columns(spark.createDataFrame([("Z",)], "duoarea string"))


def test_pages_are_bounded_even_for_many_copies(spark):
    one = tuple(rec("2024-01-01", "EPMR", "3.0").values())
    other = [tuple(rec(f"2024-02-{d:02d}", "EPD2D", "1.0").values()) for d in range(1, 11)]
    recs = spark.createDataFrame([one] * 95 + other, pg.RECORD_SCHEMA).repartition(3)
    pages = pg.records_to_pages(recs, page_size=20)
    sizes = sorted(r.n for r in pages.select(F.size("response.data").alias("n")).collect())
    assert len(sizes) == 6 and max(sizes) <= 20 and sum(sizes) == 105
    assert {r.t for r in pages.select(F.col("response.total").alias("t")).collect()} == {"105"}
    rep = pg.page_report(pages).first()
    assert (rep.pages, rep.records_found, rep.distinct_records) == (6, 105, 11)
