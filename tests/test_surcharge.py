import datetime as dt

import pytest

from pricelens.config import Fleet
from pricelens.operators import surcharge as sc

from helpers import half_up

LATEST = "area_name string, duoarea string, price_per_gallon double, wow_change double, price_date date, product string"


def latest(spark, prices):
    return spark.createDataFrame([(f"a{i}", f"R{i}", p, None, dt.date(2024, 1, 1), "EPD2DXL0")
                                  for i, p in enumerate(prices)], LATEST)


def test_point_arithmetic(spark):
    fleet = Fleet()
    r = sc.surcharge_point(latest(spark, [5.0, 5.2]), baseline=4.5, rate=0.35, fleet=fleet).first()
    avg = 5.1
    above = avg - 4.5
    g = 39 / 6.2
    assert r.avg_price == avg and r.above_baseline == half_up(above, 6)
    assert r.extra_fuel_cost_per_delivery == half_up(above * g, 6)
    assert r.surcharge_per_delivery == half_up(above / 0.1 * 0.35, 6)
    assert r.weekly_extra_fuel_cost == half_up(above * g * 5410, 6)
    rec = (above / 0.1 * 0.35 * 5410) / (above * g * 5410) * 100
    assert r.recovery_pct == half_up(rec, 6)
    assert r.break_even_rate == half_up(g * 0.1, 6)
    assert r.recovery_band == "poor"


def test_below_baseline_and_empty(spark):
    r = sc.surcharge_point(latest(spark, [4.0]), baseline=4.5, rate=0.35).first()
    assert (r.above_baseline, r.recovery_pct, r.recovery_band) == (0.0, 100.0, None)
    e = sc.surcharge_point(latest(spark, []), baseline=4.5, rate=0.35).first()
    assert e.avg_price == 5.5  # default when there is no latest price


def test_break_even_rate_recovers_fully(spark):
    fleet = Fleet(weekly_deliveries=100, miles_per_delivery=31, mpg=3.1)  # 10 gallons
    r = sc.surcharge_point(latest(spark, [5.0]), baseline=4.0, rate=1.0, fleet=fleet).first()
    assert r.break_even_rate == 1.0 and r.recovery_pct == 100.0 and r.recovery_band == "good"
    r = sc.surcharge_point(latest(spark, [5.0]), baseline=4.0, rate=0.7, fleet=fleet).first()
    assert r.recovery_pct == 70.0 and r.recovery_band == "partial"
    r = sc.surcharge_point(latest(spark, [5.0]), baseline=4.0, rate=0.0, fleet=fleet).first()
    assert r.recovery_pct == 0.0 and r.recovery_band == "poor"


def test_grid_point_equals_point(spark):
    lt = latest(spark, [5.0, 5.3, 4.9])
    grid = sc.surcharge_scenarios(lt)
    assert grid.count() == 101 * 61
    g = grid.filter("baseline_fuel_price = 4.5 AND surcharge_rate = 0.35").collect()
    p = sc.surcharge_point(lt, 4.5, 0.35).first()
    assert len(g) == 1 and g[0].asDict() == p.asDict()
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_series_truthiness_and_rounding(spark):
    rows = [(dt.date(2024, 1, 1), 5.0, 4.9, False), (dt.date(2024, 1, 8), 0.0, 5.5, False),
            (dt.date(2024, 1, 15), None, 0.0, True), (None, 5.0, 5.0, False),
            (dt.date(2024, 1, 22), None, 4.0, True)]
    df = spark.createDataFrame(rows, "price_date date, actual_price double, forecast_price double, is_forecast boolean")
    fleet = Fleet(weekly_deliveries=10, miles_per_delivery=6.2, mpg=6.2)  # 1 gallon
    got = sc.surcharge_series(df, baseline=4.5, rate=0.35, fleet=fleet).orderBy("price_date").collect()
    assert [r.price_date for r in got] == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 22)]
    # 0.5 above * 1 gal * 10 = 5; 0.5/0.1*0.35*10 = 17.5 -> 18 (half up)
    assert (got[0].extra_fuel_cost, got[0].surcharge_revenue) == (5.0, 18.0)
    assert (got[1].extra_fuel_cost, got[1].surcharge_revenue) == (10.0, 35.0)  # zero actual -> forecast
    assert (got[2].extra_fuel_cost, got[2].surcharge_revenue) == (0.0, 0.0)


def test_fleet_from_zones(spark):
    z = spark.createDataFrame([(10, 30, 6.0), (30, 50, 5.0)],
                              "deliveries_per_week int, avg_miles_per_delivery int, fleet_mpg double")
    r = sc.fleet_from_zones(z).first()
    assert r.weekly_deliveries == 40 and r.miles_per_delivery == 45.0
    assert r.gallons_per_delivery == pytest.approx((10 * 5 + 30 * 10) / 40)


def test_price_equal_to_baseline_has_no_band(spark):
    r = sc.surcharge_point(latest(spark, [4.5]), baseline=4.5, rate=0.35).first()
    assert (r.above_baseline, r.recovery_pct, r.recovery_band) == (0.0, 100.0, None)


PRICES = "product string, price_date date, actual_price double, forecast_price double, is_forecast boolean"


def series_rows(seed, n):
    import random
    rng = random.Random(seed)
    out = []
    for i in range(n):
        price = rng.choice([rng.uniform(0.2, 3.5), rng.randrange(50, 305, 5) / 100, 0.0, None, -1.0])
        date = None if rng.random() < 0.05 else dt.date(2020, 1, 5) + dt.timedelta(weeks=i)
        product = rng.choice(["A", "A", "A", "B", None])
        out.append((product, date, *((price, 9.0) if rng.random() < 0.6 else (None, price)), price is None))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_scenario_totals_equal_the_exploded_grid(spark, seed):
    grid, rates = (50, 300, 5), (0, 100, 25)
    rows = series_rows(seed, 300)
    got = {(r.product, r.baseline_fuel_price, r.surcharge_rate): r for r in sc.scenario_totals(
        spark.createDataFrame(rows, PRICES).repartition(7), Fleet(), rates, grid).collect()}
    prices = {}
    for product, date, actual, forecast, _ in rows:
        price = actual or forecast
        if date and price:
            prices.setdefault(product, []).append(round(half_up(price, 6) * 1e6))
    assert len(got) == len(prices) * 51 * 5
    for (product, base, rate), r in got.items():
        over = [p - round(base * 1e6) for p in prices[product] if p > round(base * 1e6)]
        above, g, d = sum(over) / 1e6, Fleet().gallons_per_delivery, 5410.0
        assert r.weeks_above == len(over) and r.total_above_baseline == half_up(above, 6)
        assert r.total_extra_fuel_cost == pytest.approx(above * g * d, abs=1e-5)
        assert r.total_surcharge_revenue == pytest.approx(above / 0.1 * rate * d, abs=1e-5)
        assert (r.recovery_band is None) == (not over)


def test_scenario_totals_without_prices(spark):
    assert sc.scenario_totals(spark.createDataFrame([], PRICES)).count() == 0
    none = spark.createDataFrame([("A", dt.date(2024, 1, 7), None, None, True)], PRICES)
    assert sc.scenario_totals(none).count() == 0


def test_scenario_totals_shuffle_buckets_not_rows(spark):
    """The rows are summed to buckets before the only shuffle that follows their number."""
    rows = spark.range(1000).selectExpr("'A' AS product", "date'2024-01-07' AS price_date",
                                        "1.0D + id % 3 AS actual_price", "cast(null as double) AS forecast_price")
    plan = sc.scenario_totals(rows)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Join" not in plan
    assert "partial_sum" in plan
