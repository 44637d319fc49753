import datetime as dt

import pytest

from pricelens.operators import margins as mg
from pricelens.sources.tables import ZONE_COLUMNS

from helpers import half_up

ZONE_SCHEMA = ("duoarea string, zone_name string, padd_region string, deliveries_per_week int, "
               "avg_miles_per_delivery int, revenue_per_delivery double, base_cost_per_delivery double, "
               "latitude double, longitude double, fleet_mpg double")
REGIONAL_SCHEMA = ("price_date date, product string, product_name string, product_category string, "
                   "duoarea string, area_name string, price_per_gallon double, prev_week_price double, "
                   "wow_change double")
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)


def zones(spark, rows):
    return spark.createDataFrame([r + (6.2,) for r in rows], ZONE_SCHEMA)


def regional(spark):
    rows = [
        (D1, "EPD2DXL0", "d", "Diesel", "R-A", "Alpha", 3.9, None, None),
        (D2, "EPD2DXL0", "d", "Diesel", "R-A", "Alpha", 4.0, 3.9, 0.1),
        (D2, "EPD2DXL0", "d", "Diesel", "R-B", "Beta", 5.0, None, None),
        (D1, "EPD2DXL0", "d", "Diesel", "R-C", "Lagging", 4.5, None, None),
        (D2, "EPMR", "g", "Gasoline", "R-X", "Gas only", 3.0, None, None),
    ]
    return spark.createDataFrame(rows, REGIONAL_SCHEMA)


def test_margins_formulas_and_inner_join(spark):
    z = zones(spark, [("Z1", "North", "R-A", 100, 31, 200.0, 120.0, 40.0, -90.0),
                      ("Z2", "South", "R-B", 50, 62, 180.0, 150.0, 30.0, -95.0),
                      ("Z3", "Nowhere", "R-X", 10, 10, 100.0, 50.0, 35.0, -99.0),
                      ("Z4", "Late", "R-C", 10, 10, 100.0, 50.0, 35.0, -99.0)])
    got = {r.duoarea: r for r in mg.delivery_margins(regional(spark), z).collect()}
    assert set(got) == {"Z1", "Z2"}  # no diesel price for R-X; R-C lags the latest date
    z1 = got["Z1"]
    fuel = 31 / 6.2 * 4.0
    assert z1.fuel_cost_per_delivery == half_up(fuel, 2)
    assert z1.margin_per_delivery == half_up(200 - 120 - fuel, 2)
    assert z1.margin_pct == half_up((200 - 120 - fuel) / 200 * 100, 1)
    assert z1.weekly_fuel_cost == half_up(fuel * 100, 0)
    assert z1.weekly_margin == half_up((200 - 120 - fuel) * 100, 0)
    assert (z1.region_name, z1.diesel_price, z1.diesel_wow_change, z1.price_date) == ("Alpha", 4.0, 0.1, D2)


def test_zero_revenue_margin_is_null_and_critical(spark):
    z = zones(spark, [("Z0", "Free", "R-A", 1, 10, 0.0, 0.0, 0.0, 0.0)])
    r = mg.margin_status(mg.delivery_margins(regional(spark), z)).first()
    assert r.margin_pct is None and r.status == "critical"


def test_status_thresholds(spark):
    df = spark.createDataFrame([(25.1,), (25.0,), (15.0,), (5.0,), (5.1,), (None,)], "margin_pct double")
    got = [r.s for r in df.select(mg.status_column("margin_pct").alias("s")).collect()]
    assert got == ["healthy", "watch", "warning", "critical", "warning", "critical"]


def test_missing_padd_region_is_an_error(spark):
    z = zones(spark, [("Z1", "North", "R-A", 100, 31, 200.0, 120.0, 40.0, -90.0)]).drop("padd_region")
    with pytest.raises(ValueError, match="padd_region"):
        mg.delivery_margins(regional(spark), z)


def test_fleet_totals_and_state_rollup(spark):
    ms = spark.createDataFrame([
        ("Z1", "a", 30.0, 100.0, 10.0, 4.0, 15),
        ("Z2", "b", 10.0, 200.0, 20.0, 4.0, 600),
        ("Z3", "c", 4.0, 300.0, 30.0, 4.0, 240),
        ("Z4", "d", 10.0, 400.0, 40.0, 4.0, 0),
    ], "duoarea string, zone_name string, margin_pct double, weekly_fuel_cost double, "
       "weekly_margin double, diesel_price double, deliveries_per_week int")
    st = mg.margin_status(ms)
    radius = {r.duoarea: r.marker_radius for r in st.collect()}
    assert radius == {"Z1": 4.0, "Z2": (600 / 15) ** 0.5, "Z3": 4.0, "Z4": 4.0}
    tot = mg.fleet_totals(st).first()
    assert (tot.total_weekly_fuel_cost, tot.total_weekly_margin, tot.zone_count, tot.zones_at_risk) == (
        1000.0, 100.0, 4, 3)
    bridge = mg.state_bridge(spark.createDataFrame(
        [("Z1", ["01", "02"]), ("Z2", ["02"]), ("Z4", ["02", "03"]), ("Z3", ["04"])],
        "duoarea string, states array<string>"))
    got = {r.state: r.duoarea for r in mg.state_rollup(st, bridge).collect()}
    # state 02: Z2 and Z4 tie at 10 %, the zone code breaks the tie
    assert got == {"01": "Z1", "02": "Z2", "03": "Z4", "04": "Z3"}


def test_margins_plan_broadcasts_price_side(spark):
    z = zones(spark, [("Z1", "North", "R-A", 100, 31, 200.0, 120.0, 40.0, -90.0)])
    plan = mg.delivery_margins(regional(spark), z)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert set(ZONE_COLUMNS) <= set(z.columns)
