import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.operators import aggregated_fit as af
from pricelens.operators.forecast import FORECAST_COLUMNS, Z80

CFG = Config()
SCHEMA = "product string, product_name string, price_date date, price_per_gallon double"
START = dt.date(2018, 1, 1)


def prices(n, seed=3):
    rng = np.random.default_rng(seed)
    k = np.arange(n)
    bend = np.maximum(k - n / 2, 0) * 0.01
    return np.round(2.0 + 0.003 * k + bend + 0.3 * np.sin(2 * np.pi * k / 52.18) + rng.normal(0, 0.03, n), 3)


def frame(spark, series):
    rows = [(p, p + " name", START + dt.timedelta(days=7 * i), None if y is None else float(y))
            for p, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, SCHEMA)


def features(dates, first, last):
    """Design of a row, computed directly."""
    day = np.array([(d - dt.date(1970, 1, 1)).days for d in dates], float)
    lo, hi = ((d - dt.date(1970, 1, 1)).days for d in (first, last))
    t = (day - lo) / max(hi - lo, 1)
    cps = af.CHANGEPOINT_RANGE * np.arange(1, af.CHANGEPOINTS + 1) / af.CHANGEPOINTS
    x = 2 * np.pi * np.arange(1, af.YEARLY_ORDER + 1) * day[:, None] / af.YEAR_DAYS
    return np.concatenate([np.ones((len(day), 1)), t[:, None], np.maximum(t[:, None] - cps, 0), np.sin(x), np.cos(x)], 1)


def direct_fit(ys):
    """Reweighted ridge over the rows themselves, with residuals from the rows."""
    dates = [START + dt.timedelta(days=7 * i) for i in range(len(ys))]
    x, scale = features(dates, dates[0], dates[-1]), np.max(np.abs(ys))
    y = ys / scale
    prior = np.concatenate([[1 / 25.0] * 2, [1 / 0.05] * af.CHANGEPOINTS, [1 / 100.0] * (2 * af.YEARLY_ORDER)])
    noise = np.var(y)
    for _ in range(100):
        w = np.linalg.solve(x.T @ x + noise * np.diag(prior) + 1e-10 * np.eye(x.shape[1]), x.T @ y)
        noise = max(float(np.mean((y - x @ w) ** 2)), 1e-12)
        prior[2:27] = 1 / (0.05 * np.maximum(np.abs(w[2:27]), 1e-6))
    return w, noise, np.mean(np.abs(w[2:27])), scale, dates


def test_equals_a_direct_fit_of_the_rows(spark):
    ys = {"EPMR": prices(230), "EPD2DXL0": prices(120, 5)}
    out = af.aggregated_forecast(frame(spark, ys).repartition(7), CFG).collect()
    assert tuple(out[0].asDict()) == FORECAST_COLUMNS
    for product, own in ys.items():
        w, noise, drift, scale, dates = direct_fit(own)
        mine = sorted((r for r in out if r.product == product), key=lambda r: r.price_date)
        assert len(mine) == len(own) + CFG.horizon_weeks
        x = features([r.price_date for r in mine], dates[0], dates[-1])
        assert np.max(np.abs(np.array([r.forecast_price for r in mine]) - x @ w * scale)) < 2e-3
        span = (dates[-1] - dates[0]).days
        for r in mine:
            h = max((r.price_date - dates[-1]).days / span, 0)
            half = Z80 * math.sqrt(noise + 2 * 25 / 3 * drift ** 2 * h ** 3) * scale
            assert abs((r.forecast_upper - r.forecast_lower) / 2 - half) < 1e-3
        assert [r.is_forecast for r in mine] == [False] * len(own) + [True] * CFG.horizon_weeks
        assert all(r.price_date.weekday() == 6 for r in mine if r.is_forecast)


def test_sums_do_not_depend_on_partitions_or_flushes(spark, monkeypatch):
    hist = af.dated_history(frame(spark, {"EPMR": prices(90), "EPD2DXL0": prices(60, 8)}), CFG)

    def sums(h):
        return {(r.product, r.i, r.j): r.total for r in af.gram_sums(h, af.series_frame(h)).collect()}
    one = sums(hist.coalesce(1))
    assert len(one) == 2 * af.WIDTH * (af.WIDTH + 1) // 2
    assert sums(hist.repartition(9)) == one
    monkeypatch.setattr(af, "HELD_ROWS", 7)
    monkeypatch.setattr(af, "HELD_SERIES", 1)
    assert sums(hist.repartition(3)) == one
    assert one["EPMR", 0, 0] == 90 * af.UNIT ** 2


def test_odd_rows(spark):
    flat = frame(spark, {"EPMR": [2.5], "EPD2DXL0": [None, float("nan")], "EPMP": [1.0]})
    undated = spark.createDataFrame([("EPMR", "x", None, 9.0)], SCHEMA)
    out = af.aggregated_forecast(flat.unionByName(undated), CFG, simulate=True).collect()
    one = [r for r in out if r.product == "EPMR"]
    assert len(one) == 1 + CFG.horizon_weeks
    assert all(abs(r.forecast_price - 2.5) < 1e-6 and r.forecast_lower is None for r in one)
    none = [r for r in out if r.product == "EPD2DXL0"]
    assert len(none) == 2 + CFG.horizon_weeks and all(r.is_forecast and r.forecast_price is None for r in none)
    assert af.aggregated_forecast(flat.limit(0), CFG).count() == 0


def test_rows_copied_many_times_and_gaps(spark):
    ys = list(prices(80))
    ys[10:20] = [None] * 10
    once = frame(spark, {"EPMR": ys})
    twice = once.unionByName(once)
    a, b = (af.fit_series(af.dated_history(d, CFG)).first() for d in (once, twice))
    assert (a.n, b.n) == (70, 140)
    out = af.aggregated_forecast(once, CFG).filter("is_forecast").count()
    assert out == 10 + CFG.horizon_weeks


@pytest.fixture(scope="module")
def fits(spark):
    return spark.createDataFrame(
        [("A", START, START + dt.timedelta(days=700), 700.0, 2.0, 0.0004, 0.5),
         ("B", START, START + dt.timedelta(days=70), 70.0, 1.0, 0.0001, 0.0)],
        "product string, first_date date, last_date date, span double, scale double, noise double, drift double")


def test_draws_are_repeatable_and_follow_the_closed_form(spark, fits):
    n = 20_000
    some = af.simulated_draws(fits, CFG, n, seed=11)
    stats = {(r.product, r.step): r for r in some.groupBy("product", "step").agg(
        F.count("*").alias("n"), F.avg("deviation").alias("m"), F.var_samp("deviation").alias("v"),
        F.kurtosis("deviation").alias("k"), F.percentile("deviation", F.lit(0.1)).alias("q")).collect()}
    assert len(stats) == 2 * CFG.horizon_weeks
    for r in fits.collect():
        for step in range(CFG.horizon_weeks):
            h = (6 + 7 * step) / r.span
            var = (r.noise + 2 * af.CHANGEPOINTS * r.drift ** 2 * h ** 3 / 3) * r.scale ** 2
            got = stats[r.product, step]
            assert got.n == n and abs(got.m) < 5 * math.sqrt(var / n)
            assert abs(got.v - var) < 5 * var * math.sqrt((got.k + 2) / n)
            if r.drift == 0:  # normal: the stated error of a quantile over its density
                error = math.sqrt(0.09 / n) / (0.17549833 / math.sqrt(var))
                assert abs(got.q + Z80 * math.sqrt(var)) < 5 * error

    def key(d):
        return sorted((r.product, r.step, r.deviation) for r in d.collect())
    few = key(af.simulated_draws(fits, CFG, 300, seed=1))
    assert len(few) == 2 * 300 * CFG.horizon_weeks
    assert few == key(af.simulated_draws(fits.repartition(5), CFG, 300, seed=1))
    assert few != key(af.simulated_draws(fits, CFG, 300, seed=2))


def test_simulated_bounds_replace_future_bounds_only(spark):
    weekly = frame(spark, {"EPMR": prices(150)})
    plain, drawn = ({r.price_date: r for r in af.aggregated_forecast(weekly, CFG, simulate=s).collect()}
                    for s in (False, True))
    assert plain.keys() == drawn.keys()
    for d, r in plain.items():
        assert r.forecast_price == drawn[d].forecast_price
        same = (r.forecast_lower, r.forecast_upper) == (drawn[d].forecast_lower, drawn[d].forecast_upper)
        assert same != r.is_forecast
        assert drawn[d].forecast_lower < r.forecast_price < drawn[d].forecast_upper
