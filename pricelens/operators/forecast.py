"""Forecasts of many weekly series in parallel (B-14..B-19).

Two models share one output shape (``FORECAST_SCHEMA``):

* ``linear_seasonal_forecast``: least-squares trend on the week index plus
  a week-of-year mean residual, residual-sigma interval.  Built from
  aggregations and joins only, from exact (decimal) sums, so it can be
  checked against SQL to the last digit.
* ``additive_forecast``: piecewise-linear trend with changepoints
  (Laplace prior on slope changes), yearly Fourier seasonality and a
  closed-form uncertainty interval, fit per series with numpy inside
  ``groupBy(series).applyInPandas``: one task per series, one series in
  memory at a time, nothing on the driver.

Future dates follow the weekly rule of the reference model: the next
``weekday`` (Sunday) strictly after the last date, then every 7 days.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.config import CHANGEPOINT_PRIOR, DEFAULT, FORECAST_RECENT_DAYS, FORECAST_WINDOW_DAYS, Config
from pricelens.functions.dates import as_of_column, future_weeks
from pricelens.functions.numeric import round_exact

FORECAST_SCHEMA = T.StructType([
    T.StructField("price_date", T.DateType()),
    T.StructField("forecast_price", T.DoubleType()),
    T.StructField("forecast_lower", T.DoubleType()),
    T.StructField("forecast_upper", T.DoubleType()),
    T.StructField("actual_price", T.DoubleType()),
    T.StructField("product", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("is_forecast", T.BooleanType()),
])
FORECAST_COLUMNS = tuple(f.name for f in FORECAST_SCHEMA.fields)

# The grouped-map function below runs in Python workers.  Pickling this
# module by value ships the model code inside the task closure, so the
# executors need numpy and pandas but not this package (no --py-files).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
# Fixed value: two-sided 80 % normal quantile (the interval width).
Z80 = 1.2815515594600038


def _history(weekly: DataFrame, cfg: Config, key: str = "product") -> DataFrame:
    return (weekly.filter(F.col("product").isin(list(cfg.forecast_products)))
            .select(key, "product_name", "price_date", F.col("price_per_gallon").alias("y")))


def future_dates(weekly: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """B-19: the ``horizon`` future dates of every forecast series."""
    last = _history(weekly, cfg).groupBy("product").agg(F.max("price_date").alias("last_date"))
    return last.select(
        "product", "last_date",
        F.posexplode(future_weeks(F.col("last_date"), cfg.horizon_weeks, cfg.forecast_weekday))
        .alias("step", "price_date"),
    ).select("product", "last_date", (F.col("step") + 1).alias("step"), "price_date")


def linear_seasonal_forecast(weekly: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Trend + week-of-year seasonal baseline forecast, history + horizon.

    One pass per series: the last row of the history opens into itself and
    the horizon dates (they sort after it, so ``row_number`` continues as n+1..n+8), then
    every statistic is a window aggregate over history values only, all on
    the one ``product`` partitioning: one shuffle, no joins back.
    """
    hist = _history(weekly, cfg)
    is_last = F.lead("price_date").over(Window.partitionBy("product").orderBy("price_date")).isNull()
    own = F.array(F.struct("price_date", "y", "product_name"))
    ahead = F.transform(future_weeks(F.col("price_date"), cfg.horizon_weeks, cfg.forecast_weekday),
                        lambda d: F.struct(d.alias("price_date"), F.lit(None).cast("double").alias("y"),
                                           F.lit(None).cast("string").alias("product_name")))
    rows = (hist.filter(F.col("price_date").isNotNull()).withColumn("_last", is_last)
            .select("product", F.explode(F.when(F.col("_last"), F.concat(own, ahead)).otherwise(own)).alias("r"))
            .select("product", "r.price_date", "r.y", "r.product_name"))
    by = Window.partitionBy("product")
    season = Window.partitionBy("product", "woy")
    known = F.col("y").isNotNull()
    ydec = F.col("y").try_cast("decimal(24,8)")
    tk = F.when(known, F.col("t"))
    step1 = rows.select("*", F.row_number().over(by.orderBy("price_date")).alias("t"),
                        F.weekofyear("price_date").alias("woy"))
    step2 = step1.select(
        "*",
        F.count("y").over(by).alias("n"),
        F.sum(tk).over(by).alias("st"),
        F.sum(ydec).over(by).alias("sy"),
        F.sum(tk.cast("long") * tk.cast("long")).over(by).alias("stt"),
        F.sum(tk.cast("decimal(20,0)") * ydec).over(by).alias("sty"),
        F.min_by("product_name", F.when(known, F.col("price_date"))).over(by).alias("first_name"),
        F.count("y").over(season).alias("c"),
        F.sum(ydec).over(season).alias("syw"),
        F.sum(tk).over(season).alias("stw"),
    )
    n, st, sy = (F.col(c).cast("double") for c in ("n", "st", "sy"))
    stt, sty = F.col("stt").cast("double"), F.col("sty").cast("double")
    slope = F.coalesce(F.try_divide(n * sty - st * sy, n * stt - st * st), F.lit(0.0))
    step3 = step2.select("*", slope.alias("b")).select(
        "*", ((sy - F.col("b") * st) / n).alias("a"))
    c = F.col("c").cast("double")
    adj = F.try_divide(F.col("syw").cast("double"), c) - (
        F.col("a") + F.col("b") * F.try_divide(F.col("stw").cast("double"), c))
    step4 = step3.select(
        "*", (F.col("a") + F.col("b") * F.col("t").cast("double")
              + F.coalesce(adj, F.lit(0.0))).alias("fit"))
    sigma = F.stddev_samp(F.col("y") - F.col("fit")).over(by)
    z = F.lit(Z80)
    return step4.select("*", sigma.alias("sigma")).select(
        "price_date",
        round_exact("fit", 6).alias("forecast_price"),
        round_exact(F.col("fit") - z * F.col("sigma"), 6).alias("forecast_lower"),
        round_exact(F.col("fit") + z * F.col("sigma"), 6).alias("forecast_upper"),
        F.col("y").alias("actual_price"), "product",
        F.col("first_name").alias("product_name"),
        F.col("y").isNull().alias("is_forecast"),
    )


# --- additive model (numpy, per series) ------------------------------------

def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    x = 2.0 * np.pi * np.arange(1, order + 1)[None, :] * days[:, None] / period
    return np.concatenate([np.sin(x), np.cos(x)], axis=1)


def fit_additive(dates: np.ndarray, y: np.ndarray, future: np.ndarray, *,
                 changepoint_prior: float = CHANGEPOINT_PRIOR, n_changepoints: int = 25,
                 changepoint_range: float = 0.8, yearly_order: int = 10,
                 seasonality_prior: float = 10.0, iterations: int = 100,
                 interval: float = Z80) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """MAP fit of trend + changepoints + yearly seasonality on one series.

    ``dates``/``future``: datetime64[D]; returns (yhat, lower, upper) for
    ``concat(dates, future)``.  The Laplace prior on slope changes is met by
    iteratively reweighted ridge with a fixed number of rounds, so the
    result does not depend on a convergence test.
    """
    all_dates = np.concatenate([dates, future])
    n = len(y)
    if n == 0:
        return (np.full(0, np.nan),) * 3
    if n < 2:
        flat = np.full(len(all_dates), float(y[0]))
        return flat, np.full(len(all_dates), np.nan), np.full(len(all_dates), np.nan)
    epoch = all_dates.astype("datetime64[D]").astype(np.int64).astype(float)
    start, span = epoch[0], max(epoch[n - 1] - epoch[0], 1.0)
    t = (epoch - start) / span
    y_scale = float(np.max(np.abs(y))) or 1.0
    yy = y / y_scale
    hist_size = int(math.floor(n * changepoint_range))
    s_count = max(0, min(n_changepoints, hist_size - 1))
    if s_count > 0:
        idx = np.linspace(0, hist_size - 1, s_count + 1).round().astype(int)[1:]
        cps = t[idx]
    else:
        cps = np.zeros(0)

    def design(tt: np.ndarray, days: np.ndarray) -> np.ndarray:
        hinge = np.maximum(tt[:, None] - cps[None, :], 0.0)
        return np.concatenate([np.ones((len(tt), 1)), tt[:, None], hinge,
                               _fourier(days, 365.25, yearly_order)], axis=1)

    X = design(t, epoch)
    Xh = X[:n]
    p_trend, p_cp = 2, len(cps)
    base = np.concatenate([np.full(p_trend, 1.0 / 25.0), np.zeros(p_cp),
                           np.full(2 * yearly_order, 1.0 / seasonality_prior ** 2)])
    cp_slice = slice(p_trend, p_trend + p_cp)
    cp_w = np.full(p_cp, 1.0 / changepoint_prior)
    XtX, Xty = Xh.T @ Xh, Xh.T @ yy
    sigma2 = float(np.var(yy)) or 1e-4
    w = np.zeros(X.shape[1])
    for _ in range(iterations):
        D = base.copy()
        D[cp_slice] = cp_w
        A = XtX + sigma2 * np.diag(D) + 1e-10 * np.eye(X.shape[1])
        w = np.linalg.solve(A, Xty)
        r = yy - Xh @ w
        sigma2 = max(float(r @ r) / n, 1e-12)
        # Laplace prior |d|/tau as a quadratic d^2 / (2 tau |d_prev|).
        cp_w = 1.0 / (changepoint_prior * np.maximum(np.abs(w[cp_slice]), 1e-6))
    yhat = X @ w
    # Interval: residual noise plus trend drift beyond the history, changes
    # of Laplace scale mean|delta| arriving at the historical rate.
    lam = float(np.mean(np.abs(w[cp_slice]))) if p_cp else 0.0
    h = np.maximum(t - 1.0, 0.0)
    var = sigma2 + 2.0 * lam ** 2 * max(p_cp, 1) * h ** 3 / 3.0
    half = interval * np.sqrt(var)
    return yhat * y_scale, (yhat - half) * y_scale, (yhat + half) * y_scale


def _future_dates_np(last: np.datetime64, horizon: int, weekday: str) -> np.ndarray:
    target = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"].index(weekday[:3].title())
    last_d = last.astype("datetime64[D]")
    dow = int((last_d.astype(np.int64) - 4) % 7)  # 1970-01-05 was a Monday
    ahead = (target - dow) % 7 or 7
    first = last_d + np.timedelta64(ahead, "D")
    return first + np.arange(horizon) * np.timedelta64(7, "D")


def additive_forecast(weekly: DataFrame, cfg: Config = DEFAULT, **model_args) -> DataFrame:
    """B-14: additive model per forecast series, history + horizon rows,
    actuals joined back, ``is_forecast`` where there is no actual."""
    horizon, weekday = cfg.horizon_weeks, cfg.forecast_weekday

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("price_date", kind="stable")
        dates = pd.to_datetime(pdf["price_date"]).to_numpy().astype("datetime64[D]")
        y = pdf["y"].to_numpy(dtype=float)
        fut = _future_dates_np(dates[-1], horizon, weekday)
        yhat, lo, hi = fit_additive(dates, y, fut, **model_args)
        all_dates = np.concatenate([dates, fut])
        actual = np.concatenate([y, np.full(len(fut), np.nan)])
        out = pd.DataFrame({
            "price_date": pd.to_datetime(all_dates).date,
            "forecast_price": np.round(yhat, 6),
            "forecast_lower": np.round(lo, 6),
            "forecast_upper": np.round(hi, 6),
            "actual_price": actual,
            "product": pdf["product"].iloc[0],
            "product_name": pdf["product_name"].iloc[0],
        })
        out["is_forecast"] = np.isnan(actual)
        # null, never NaN, for missing values
        return out.astype(object).where(pd.notna(out), None)

    hist = _history(weekly, cfg)
    return hist.groupBy("product").applyInPandas(per_series, schema=FORECAST_SCHEMA)


# --- forecast reads -----------------------------------------------------------

def last_actual_date(forecast: DataFrame, product: str | None = None):
    """Scalar subquery: the newest date that has an actual price."""
    rows = forecast.filter(F.col("actual_price").isNotNull())
    if product is not None:
        rows = rows.filter(F.col("product") == product)
    return rows.agg(F.max("price_date")).scalar()


LATEST_ACTUAL = "latest_actual"


def forecast_window(forecast: DataFrame, product: str, as_of=None,
                    days: int = FORECAST_WINDOW_DAYS) -> DataFrame:
    """B-15: one product from ``days`` before ``as_of`` (default today).

    ``as_of="latest_actual"`` anchors the window at the series' own newest
    actual date (a window maximum over the series, no second pass)."""
    one = forecast.filter(F.col("product") == product)
    if isinstance(as_of, str) and as_of == LATEST_ACTUAL:
        one = one.withColumn("_anchor", F.max(
            F.when(F.col("actual_price").isNotNull(), F.col("price_date"))).over(
            Window.partitionBy("product")))
        anchor = F.col("_anchor")
    else:
        anchor = as_of_column(as_of)
    return (one.filter(F.col("price_date") >= F.date_sub(anchor, days))
            .select("price_date", "actual_price", "forecast_price", "forecast_lower",
                    "forecast_upper", "is_forecast", "product_name", "product")
            .orderBy("price_date"))


def forecast_future(forecast: DataFrame) -> DataFrame:
    """B-16: forecast rows only."""
    return forecast.filter(F.col("is_forecast")).orderBy("product_name", "price_date")


def forecast_recent(forecast: DataFrame, as_of=None, days: int = FORECAST_RECENT_DAYS) -> DataFrame:
    """B-17: every series from ``days`` before ``as_of``, future included.
    ``as_of="latest_actual"`` anchors at the newest actual date of all series,
    a scalar over partial maxima; the rows themselves are never gathered."""
    if isinstance(as_of, str) and as_of == LATEST_ACTUAL:
        lower = F.date_sub(last_actual_date(forecast), days)
        return forecast.filter(F.col("price_date") >= lower).orderBy("product_name", "price_date")
    lower = F.date_sub(as_of_column(as_of), days)
    return forecast.filter(F.col("price_date") >= lower).orderBy("product_name", "price_date")


def forecast_bridge(rows: DataFrame) -> DataFrame:
    """B-18: an actual row directly followed by a forecast row takes the
    actual as its forecast, so the two lines meet; adds the first forecast
    date of each series.  Window per series over a date window (bounded)."""
    w = Window.partitionBy("product").orderBy("price_date")
    nxt = F.lead("is_forecast").over(w)
    first_fc = F.min(F.when(F.col("is_forecast"), F.col("price_date"))).over(Window.partitionBy("product"))
    return rows.select(
        *[c for c in rows.columns if c != "forecast_price"],
        F.when(F.col("actual_price").isNotNull() & F.coalesce(nxt, F.lit(False)), F.col("actual_price"))
        .otherwise(F.col("forecast_price")).alias("forecast_price"),
        first_fc.alias("forecast_start"),
    )
