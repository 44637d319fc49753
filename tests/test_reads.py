import pytest
from pyspark.sql import functions as F

from pricelens.operators import reads as rd
from pricelens.operators.series import regional_comparison, weekly_summary

from helpers import silver_df, silver_rows, week


@pytest.fixture()
def weekly(spark):
    rows = (silver_rows("EPMR", [2.0, 2.1, 2.2, 2.1])
            + silver_rows("EPD2DXL0", [3.0, 3.0, 3.1, 3.3])
            + silver_rows("EPM0", [2.5, 2.4, 2.4, 2.6])
            + silver_rows("EPMP", [3.0, 3.1, 3.2]))  # ends a week earlier
    return weekly_summary(silver_df(spark, rows))


def test_snapshot_global_latest_drops_lagging_product(weekly):
    got = rd.snapshot(weekly).collect()
    assert [r.product_name for r in got] == ["No 2 Diesel Ultra Low Sulfur", "Regular Gasoline",
                                             "Total Gasoline"]
    assert {r.price_date for r in got} == {week(3)}


def test_snapshot_cards_priority_and_labels(spark, weekly):
    cards = rd.snapshot_cards(rd.snapshot(weekly)).collect()
    assert [(c.slot, c.slot_product, c.product) for c in cards] == [
        (0, "EPMR", "EPMR"), (1, "EPD2DXL0", "EPD2DXL0"), (2, "EPM0", "EPM0")]
    by = {c.product: c for c in cards}
    assert by["EPMR"].wow_direction == "down" and by["EPMR"].wow_abs == pytest.approx(0.1)
    assert by["EPD2DXL0"].wow_direction == "up"


def test_snapshot_cards_first_match_wins(spark):
    rows = (silver_rows("EPMR", [2.0], name="Regular Gasoline")
            + silver_rows("EPXX", [9.0], name="Regular Gasoline Blend")
            + silver_rows("EPZZ", [1.0], name="Another Regular"))
    snap = silver_df(spark, rows).select(
        "product_name", "product_category", "price_per_gallon",
        F.lit(None).cast("double").alias("wow_change"), F.lit(None).cast("double").alias("wow_pct_change"),
        F.lit(None).cast("double").alias("mom_change"), F.lit(1.0).alias("avg_4wk"),
        F.lit(1.0).alias("avg_12wk"), "price_date", "product")
    cards = rd.snapshot_cards(snap).collect()
    # name order: "Another Regular" sorts first and takes the slot
    assert [(c.slot, c.product, c.wow_direction) for c in cards] == [(0, "EPZZ", None)]


def test_trends_clamp_and_order(weekly):
    got = rd.trends(weekly, "EPMR", 2).collect()
    assert [r.price_date for r in got] == [week(2), week(3)]
    assert rd.trends(weekly, "EPMR", 0).count() == 1
    assert rd.trends(weekly, "EPMR", 10_000).count() == 4
    assert rd.trends(weekly, "EPD2D", 5).count() == 0  # valid code, not in gold
    with pytest.raises(ValueError):
        rd.trends(weekly, "BAD", 5)


def test_trends_per_product(weekly):
    got = rd.trends_per_product(weekly, 2).groupBy("product").count().collect()
    assert {(r.product, r["count"]) for r in got} == {("EPMR", 2), ("EPD2DXL0", 2), ("EPM0", 2), ("EPMP", 2)}


def test_products_distinct_and_ordered(weekly):
    got = [(r.product_category, r.product_name) for r in rd.products(weekly).collect()]
    assert got == sorted(got) and len(got) == 4


@pytest.fixture()
def regional(spark):
    rows = (silver_rows("EPD2DXL0", [3.0, 3.1])
            + silver_rows("EPD2DXL0", [3.5, 3.6], area="WEST", duoarea="R5")
            + silver_rows("EPD2DXL0", [2.9, 2.8], area="EAST", duoarea="R1")
            + silver_rows("EPD2DXL0", [3.3], area="LAG", duoarea="R9")       # lags
            + silver_rows("EPMR", [2.0, 2.0, 2.1], area="EAST", duoarea="R1"))
    return regional_comparison(silver_df(spark, rows))


def test_regional_latest_per_product_scope(regional):
    got = rd.regional_latest(regional, "EPD2DXL0").collect()
    assert [r.duoarea for r in got] == ["R5", "R1"]  # national and lagging area out
    assert {r.price_date for r in got} == {week(1)}


def test_regional_latest_global_scope_can_be_empty(regional):
    assert rd.regional_latest_global(regional, "EPD2DXL0").count() == 0
    assert [r.duoarea for r in rd.regional_latest_global(regional, "EPMR").collect()] == ["R1"]


def test_regional_position(spark, regional):
    pos = rd.regional_position(rd.regional_latest(regional, "EPD2DXL0")).orderBy("duoarea").collect()
    assert [(r.duoarea, r.position_pct, r.direction) for r in pos] == [("R1", 0.0, "down"), ("R5", 100.0, "up")]
    assert pos[0].axis_min == pytest.approx(2.8 * 0.9) and pos[0].axis_max == pytest.approx(3.6 * 1.02)
    same = rd.regional_position(spark.createDataFrame(
        [("P", week(0), "A", "a", 2.0, None), ("P", week(0), "B", "b", 2.0, 0.0)],
        "product string, price_date date, duoarea string, area_name string, price_per_gallon double, wow_change double"))
    got = same.orderBy("duoarea").collect()
    assert [r.position_pct for r in got] == [None, None]
    assert [r.direction for r in got] == ["flat", "flat"]


def test_previews_and_profile(spark, weekly):
    assert rd.weekly_preview(weekly, 3).count() == 3
    first = rd.weekly_preview(weekly, 3).first()
    assert first.price_date == week(3)
    bronze = spark.createDataFrame([("a", "2024-01-08"), ("a", "2024-01-01"), ("b", "2024-02-01")],
                                   "`product-name` string, period string")
    prof = rd.ingest_profile(bronze).collect()
    assert [(r["product-name"], r.row_count, r.earliest, r.latest) for r in prof] == [
        ("a", 2, "2024-01-01", "2024-01-08"), ("b", 1, "2024-02-01", "2024-02-01")]


def test_regional_latest_each_equals_per_product_reads(spark, regional):
    each = rd.regional_latest_each(regional, ["EPD2DXL0", "EPMR"])
    one_by_one = rd.regional_latest(regional, "EPD2DXL0").unionByName(rd.regional_latest(regional, "EPMR"))
    assert sorted(map(tuple, each.collect())) == sorted(map(tuple, one_by_one.collect()))


def test_null_area_name_is_dropped_like_sql_not_equal(spark):
    rows = (silver_rows("EPD2DXL0", [3.0, 3.1]) + silver_rows("EPD2DXL0", [4.0, 4.1], area="E", duoarea="R1")
            + [(week(1), "EPD2DXL0", "d", "Diesel", "R9", None, 5.0, "s", "d", "$/GAL")])
    from pricelens.operators.series import regional_comparison as rc
    got = [r.duoarea for r in rd.regional_latest(rc(silver_df(spark, rows)), "EPD2DXL0").collect()]
    assert got == ["R1"]
