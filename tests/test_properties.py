"""Property tests: results do not depend on row order or partitioning, and
random series agree with a brute-force computation."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricelens.operators import margins as mg
from pricelens.operators.series import regional_comparison, weekly_summary
from pricelens.sources import adapter

from conftest import SF_SMALL
from helpers import half_up, silver_df, silver_rows

prices = st.lists(st.integers(min_value=500, max_value=6000).map(lambda c: c / 1000.0),
                  min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=prices, b=prices, seed=st.integers(0, 10_000), parts=st.integers(1, 7))
def test_weekly_summary_order_and_partition_free(spark, a, b, seed, parts):
    rows = silver_rows("EPMR", a) + silver_rows("EPM0", b)
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    base = weekly_summary(silver_df(spark, rows)).collect()
    other = weekly_summary(silver_df(spark, shuffled).repartition(parts)).collect()
    assert sorted(map(tuple, base)) == sorted(map(tuple, other))
    # brute force on the 4-row mean
    got = {(r.product, r.price_date): r.avg_4wk for r in base}
    for product, series in (("EPMR", a), ("EPM0", b)):
        for i, row in enumerate(silver_rows(product, series)):
            window = series[max(0, i - 3): i + 1]
            assert got[(product, row[0])] == half_up(sum(window) / len(window), 4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), parts=st.integers(1, 9))
def test_regional_and_margins_partition_free(spark, seed, parts):
    rng = random.Random(seed)
    rows = []
    for area in ("R1", "R2", "R3"):
        rows += silver_rows("EPD2DXL0", [round(rng.uniform(2, 5), 3) for _ in range(6)],
                            area=f"A{area}", duoarea=area)
    base = regional_comparison(silver_df(spark, rows))
    moved = regional_comparison(silver_df(spark, rows).repartition(parts))
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, moved.collect()))
    zones = adapter.delivery_zones(spark, SF_SMALL).withColumn(
        "padd_region", adapter.F.concat(adapter.F.lit("R"), (adapter.F.length("duoarea") % 3 + 1).cast("string")))
    m1 = mg.delivery_margins(base, zones).collect()
    m2 = mg.delivery_margins(moved, zones.repartition(parts)).collect()
    assert len(m1) > 0 and sorted(map(tuple, m1)) == sorted(map(tuple, m2))


def _point_brute(prices, baseline, rate, fleet):
    """The what-if arithmetic written out directly."""
    avg = sum(prices) / len(prices) if prices else 5.5
    above = max(0.0, avg - baseline)
    g = fleet.miles_per_delivery / fleet.mpg
    extra = above * g * fleet.weekly_deliveries
    rev = above / 0.1 * rate * fleet.weekly_deliveries
    rec = rev / extra * 100 if extra > 0 else 100.0
    band = None if not above > 0 else ("good" if rec >= 100 else "partial" if rec >= 70 else "poor")
    return avg, above, extra, rev, rec, band


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(cents=st.lists(st.integers(100, 900), min_size=0, max_size=6),
       base=st.integers(300, 600), rate=st.integers(0, 100),
       deliveries=st.integers(1, 10_000), miles=st.integers(1, 90))
def test_surcharge_point_matches_direct_arithmetic(spark, cents, base, rate, deliveries, miles):
    import datetime as dt

    import pytest

    from pricelens.config import Fleet
    from pricelens.operators import surcharge as sc
    prices = [c / 100.0 for c in cents]
    fleet = Fleet(weekly_deliveries=deliveries, miles_per_delivery=miles, mpg=6.2)
    rows = [(f"a{i}", f"R{i}", p, None, dt.date(2024, 1, 1), "EPD2DXL0") for i, p in enumerate(prices)]
    latest_rows = spark.createDataFrame(rows, "area_name string, duoarea string, price_per_gallon double, "
                                              "wow_change double, price_date date, product string")
    r = sc.surcharge_point(latest_rows, base / 100.0, rate / 100.0, fleet).first()
    avg, above, extra, rev, rec, band = _point_brute(prices, base / 100.0, rate / 100.0, fleet)
    assert r.avg_price == pytest.approx(avg, abs=1e-6)
    assert r.weekly_extra_fuel_cost == pytest.approx(extra, abs=1e-5)
    assert r.weekly_surcharge_revenue == pytest.approx(rev, abs=1e-5)
    assert r.recovery_pct == pytest.approx(rec, abs=1e-5)
    if abs(rec - 100) > 1e-6 and abs(rec - 70) > 1e-6:  # exact band edges: rounding noise
        assert r.recovery_band == band


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(zones=st.lists(st.tuples(st.integers(1, 900), st.integers(1, 60), st.integers(0, 300),
                                st.integers(0, 200)), min_size=1, max_size=8),
       price_mills=st.integers(1000, 6000))
def test_margins_match_direct_formulas(spark, zones, price_mills):
    import datetime as dt

    from pricelens.operators import margins as mg
    price = price_mills / 1000.0
    regional = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "EPD2DXL0", "d", "Diesel", "R1", "East", price, None, None)],
        "price_date date, product string, product_name string, product_category string, duoarea string, "
        "area_name string, price_per_gallon double, prev_week_price double, wow_change double")
    rows = [(f"Z{i}", f"z{i}", "R1", d, m, float(rev), float(base), 0.0, 0.0, 6.2)
            for i, (d, m, rev, base) in enumerate(zones)]
    z = spark.createDataFrame(rows, "duoarea string, zone_name string, padd_region string, "
                              "deliveries_per_week int, avg_miles_per_delivery int, revenue_per_delivery double, "
                              "base_cost_per_delivery double, latitude double, longitude double, fleet_mpg double")
    got = {r.duoarea: r for r in mg.margin_status(mg.delivery_margins(regional, z)).collect()}
    for i, (d, m, rev, base) in enumerate(zones):
        r = got[f"Z{i}"]
        fuel = (m / 6.2) * price
        margin = rev - base - fuel
        assert r.fuel_cost_per_delivery == half_up(fuel, 2)
        assert r.margin_per_delivery == half_up(margin, 2)
        assert r.margin_pct == (None if rev == 0 else half_up(margin / rev * 100, 1))
        assert r.weekly_fuel_cost == half_up(fuel * d, 0)
        assert r.weekly_margin == half_up(margin * d, 0)
        pct = r.margin_pct or 0.0
        expect = "healthy" if pct > 25 else "watch" if pct > 15 else "warning" if pct > 5 else "critical"
        assert r.status == expect


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(20, 120), seed=st.integers(0, 1000))
def test_linear_seasonal_matches_numpy(spark, n, seed):
    import datetime as dt

    import numpy as np

    from pricelens.operators import forecast as fc
    rng = random.Random(seed)
    prices = [round(2 + 0.01 * i + rng.uniform(-0.2, 0.2), 3) for i in range(n)]
    w = weekly_summary(silver_df(spark, silver_rows("EPMR", prices)))
    got = fc.linear_seasonal_forecast(w).orderBy("price_date").collect()
    t = np.arange(1, n + 1, dtype=float)
    y = np.array(prices)
    b, a = np.polyfit(t, y, 1)
    dates = [r.price_date for r in got]
    woy = np.array([d.isocalendar()[1] for d in dates])
    resid = y - (a + b * t)
    adj = {k: resid[woy[:n] == k].mean() for k in set(woy[:n])}
    fit_all = np.array([a + b * (i + 1) + adj.get(woy[i], 0.0) for i in range(n + 8)])
    sigma = np.std(y - fit_all[:n], ddof=1)
    assert len(got) == n + 8
    assert all(d.weekday() == 6 for d in dates[n:]) and dates[n] > dates[n - 1]
    assert all(dt.timedelta(days=7) == dates[i + 1] - dates[i] for i in range(n, n + 7))
    for i, r in enumerate(got):
        assert abs(r.forecast_price - fit_all[i]) < 2e-6
        assert abs((r.forecast_upper - r.forecast_price) - fc.Z80 * sigma) < 5e-6
