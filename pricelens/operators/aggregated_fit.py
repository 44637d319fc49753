"""B-14 fitted by aggregation, for series that do not fit in a task.

The additive model needs only sums over a series: the Gram matrix of its
features and the price.  Features are whole millionths, so these sums are
exact integers and do not depend on partitioning or on retried tasks.

1. One aggregate per series: first and last date, rows, price scale.
2. Per task, the Gram rows of each series it holds (numpy, a bounded number
   of series at a time); then one sum per (series, i, j), combined before
   the shuffle.  A task never holds a series.
3. Per series, a ridge solve over its 48 x 48 sums.  The Laplace prior on
   slope changes is met by reweighting for a fixed number of rounds; the
   residual sum of squares comes from the Gram matrix too.
4. Fitted values of the rows, history and horizon, in the JVM: the row's
   features times the coefficients of its series.

Changepoints are spread evenly over the first part of the *time* between the
first and last date (a rank of rows would need the whole series in order).

Defined results: rows without a date are left out; a row without a finite
price takes no part in the fit and reads as a forecast row; a series with
one price is flat and has no interval; one without prices has null forecasts.

Intervals are closed-form, or simulated: seeded draws of future slope
changes and noise per series, with exact quantiles by aggregation.  With S
draws the share of draws below a simulated bound has standard error
sqrt(q (1 - q) / S), 0.0095 at 1,000 draws and q = 0.1.
"""

from __future__ import annotations

import math
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.config import CHANGEPOINT_PRIOR, DEFAULT, Config
from pricelens.functions.dates import future_weeks
from pricelens.operators.forecast import FORECAST_COLUMNS, Z80, _history
from pricelens.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 1_000_000        # features are counted in millionths
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_ORDER = 10
YEAR_DAYS = 365.25
WIDTH = 2 + CHANGEPOINTS + 2 * YEARLY_ORDER + 1  # the last one is the price
HELD_SERIES = 1000      # Gram matrices that a task holds before it passes them on
HELD_ROWS = 1_000_000   # rows summed into one matrix: products stay below 2 ** 63
DRAWS = 1000
DRAWS_PER_ROW = 250
QUANTILES = (0.1, 0.9)


def changepoint_units() -> list[int]:
    return [math.floor(UNIT * CHANGEPOINT_RANGE * k / CHANGEPOINTS + 0.5) for k in range(1, CHANGEPOINTS + 1)]


def _units(x: Column) -> Column:
    return F.floor(x * F.lit(float(UNIT)) + F.lit(0.5))


def feature_columns() -> list[Column]:
    """Features of a row with price_date, first_date and span, in millionths."""
    day = F.unix_date("price_date").cast("double")
    t = _units((day - F.unix_date("first_date").cast("double")) / F.col("span"))
    turns = [F.lit(2.0 * math.pi * k / YEAR_DAYS) * day for k in range(1, YEARLY_ORDER + 1)]
    return [F.lit(UNIT).cast("long"), t,
            *[F.greatest(t - F.lit(c), F.lit(0)).cast("long") for c in changepoint_units()],
            *[_units(F.sin(x)) for x in turns], *[_units(F.cos(x)) for x in turns]]


def dated_history(weekly: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    y = F.col("y")
    return (_history(weekly, cfg).filter(F.col("price_date").isNotNull())
            .withColumn("y", F.when(~F.isnan(y) & (F.abs(y) < float("inf")), y)))


def series_frame(hist: DataFrame) -> DataFrame:
    """Per series: dates, number of prices, price scale, name."""
    known = F.col("y").isNotNull()
    return (hist.groupBy("product")
            .agg(F.min("price_date").alias("first_date"), F.max("price_date").alias("last_date"),
                 F.count("y").alias("n"), F.max(F.abs("y")).alias("top"),
                 F.min_by("product_name", F.when(known, F.col("price_date"))).alias("product_name"))
            .select("product", "product_name", "first_date", "last_date", "n",
                    F.greatest(F.datediff("last_date", "first_date"), F.lit(1)).cast("double").alias("span"),
                    F.when(F.col("top") > 0, F.col("top")).otherwise(F.lit(1.0)).alias("scale")))


def _gram_rows(batches):
    """Batches of (product, z) -> (product, i, products of feature i with features i and up)."""
    held: dict = {}

    def passed(keys):
        cols = [[], [], []]
        for key in keys:
            _, gram = held.pop(key)
            for i in range(len(gram)):
                for col, v in zip(cols, (key, i, gram[i, i:].tolist()), strict=True):
                    col.append(v)
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                           pa.array(cols[2], pa.list_(pa.int64()))], ["product", "i", "sums"])

    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode()
        at, keys = codes.indices.to_numpy(), codes.dictionary.to_pylist()
        z = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
        for k, key in enumerate(keys):
            own = z[at == k]
            for start in range(0, len(own), HELD_ROWS):
                some = own[start:start + HELD_ROWS]
                if key in held and held[key][0] + len(some) > HELD_ROWS:
                    yield passed([key])
                rows, gram = held.get(key, (0, 0))
                held[key] = (rows + len(some), gram + some.T @ some)
            if len(held) >= HELD_SERIES:
                yield passed(list(held))
    if held:
        yield passed(list(held))


def gram_sums(hist: DataFrame, series: DataFrame) -> DataFrame:
    """Exact sums per (product, i, j), i <= j; the last index is the price
    over its series' scale."""
    rows = hist.filter("y is not null").select("product", "price_date", "y").join(
        series.select("product", "first_date", "span", "scale"), "product")
    z = rows.select("product", F.array(*feature_columns(), _units(F.col("y") / F.col("scale"))).alias("z"))
    parts = z.mapInArrow(_gram_rows, "product string, i int, sums array<long>")
    return (parts.select("product", "i", F.posexplode("sums").alias("ahead", "one"))
            .groupBy("product", "i", (F.col("i") + F.col("ahead")).alias("j"))
            .agg(F.sum(F.col("one").cast("decimal(28,0)")).alias("total")))


def solve_gram(gram: np.ndarray, n: int, *, changepoint_prior: float = CHANGEPOINT_PRIOR,
               seasonality_prior: float = 10.0, iterations: int = 100) -> tuple[np.ndarray, float, float]:
    """Coefficients, noise variance and mean slope change from the Gram matrix
    (features, then price) of ``n`` rows."""
    xtx, xty, yty = gram[:-1, :-1], gram[:-1, -1], float(gram[-1, -1])
    prior = np.concatenate([np.full(2, 1.0 / 25.0), np.full(CHANGEPOINTS, 1.0 / changepoint_prior),
                            np.full(2 * YEARLY_ORDER, 1.0 / seasonality_prior ** 2)])
    changes = slice(2, 2 + CHANGEPOINTS)
    noise = max(yty / n - (float(xty[0]) / n) ** 2, 0.0) or 1e-4
    w = np.zeros(len(xtx))
    for _ in range(iterations):
        w = np.linalg.solve(xtx + noise * np.diag(prior) + 1e-10 * np.eye(len(xtx)), xty)
        noise = max((yty - 2.0 * float(w @ xty) + float(w @ xtx @ w)) / n, 1e-12)
        prior[changes] = 1.0 / (changepoint_prior * np.maximum(np.abs(w[changes]), 1e-6))
    return w, noise, float(np.mean(np.abs(w[changes])))


def fit_series(hist: DataFrame, **priors) -> DataFrame:
    """``series_frame`` with w (coefficients), noise and drift per series."""
    series = series_frame(hist)
    by_series = gram_sums(hist, series).groupBy("product").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "j", "total"))),
                    lambda s: s["total"].cast("double")).alias("sums"))
    upper = np.triu_indices(WIDTH)

    def solve(batches):
        for pdf in batches:
            out = {"product": [], "w": [], "noise": [], "drift": []}
            for product, n, sums in zip(pdf["product"], pdf["n"], pdf["sums"], strict=True):
                gram = np.zeros((WIDTH, WIDTH))
                gram[upper] = np.asarray(sums, float) / float(UNIT) ** 2
                gram = gram + np.triu(gram, 1).T
                if n < 2:  # flat, without an interval
                    w, noise, drift = np.zeros(WIDTH - 1), None, None
                    w[0] = gram[0, -1]
                else:
                    w, noise, drift = solve_gram(gram, int(n), **priors)
                for name, v in zip(out, (product, w.tolist(), noise, drift), strict=True):
                    out[name].append(v)
            import pandas as pd
            yield pd.DataFrame(out)

    fitted = (by_series.join(series.select("product", "n"), "product")
              .mapInPandas(solve, "product string, w array<double>, noise double, drift double"))
    return series.join(fitted, "product", "left")


def _future(fits: DataFrame, cfg: Config) -> Column:
    return future_weeks(F.col("last_date"), cfg.horizon_weeks, cfg.forecast_weekday)


def simulated_draws(fits: DataFrame, cfg: Config = DEFAULT, draws: int = DRAWS, seed: int = 0) -> DataFrame:
    """Seeded draws per series and future date: deviation from the forecast.

    Slope changes arrive at the historical rate (a Poisson number, uniform
    over the horizon) with Laplace sizes of the mean historical change; noise
    is normal.  Draws come in blocks that are rows of their own; a block's
    generator is seeded by (seed, series, block), so neither partitioning nor
    a retried task changes a draw."""
    blocks = math.ceil(draws / DRAWS_PER_ROW)

    def draw(batches):
        import pandas as pd
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                rng = np.random.default_rng([seed, zlib.crc32(r.product.encode()), r.block])
                size = min(DRAWS_PER_ROW, draws - r.block * DRAWS_PER_ROW)
                ahead = np.asarray(r.ahead, float)
                count = rng.poisson(CHANGEPOINTS * ahead.max(), size)
                of = np.repeat(np.arange(size), count)
                at = rng.uniform(0.0, ahead.max(), len(of))
                change = rng.laplace(0.0, r.drift, len(of))
                path = np.zeros((size, len(ahead)))
                np.add.at(path, of, change[:, None] * np.maximum(ahead[None, :] - at[:, None], 0.0))
                path += rng.normal(0.0, math.sqrt(r.noise), path.shape)
                yield pd.DataFrame({"product": r.product, "step": np.tile(np.arange(len(ahead)), size),
                                    "deviation": (path * r.scale).ravel()})

    ahead = F.transform(_future(fits, cfg), lambda d: F.datediff(d, F.col("last_date")) / F.col("span"))
    rows = fits.filter("noise is not null").select(
        "product", "noise", "drift", "scale", ahead.alias("ahead"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return rows.repartition("product", "block").mapInPandas(draw, "product string, step int, deviation double")


def aggregated_forecast(weekly: DataFrame, cfg: Config = DEFAULT, simulate: bool = False, draws: int = DRAWS,
                        seed: int = 0, **priors) -> DataFrame:
    """History and horizon rows in ``FORECAST_SCHEMA``; with ``simulate`` the
    bounds of future rows are quantiles of ``simulated_draws``.

    History and fits are written once, so that the rows behind them are read
    once and the few coefficients are planned by their size."""
    hist = materialize(dated_history(weekly, cfg))
    fits = materialize(fit_series(hist, **priors))
    own = hist.select("product", "price_date", "y", F.lit(None).cast("int").alias("step"))
    ahead = fits.select("product", F.posexplode(_future(fits, cfg)).alias("step", "price_date")).select(
        "product", "price_date", F.lit(None).cast("double").alias("y"), "step")
    rows = own.unionByName(ahead).join(fits, "product")
    fit = F.aggregate(F.zip_with("w", F.array(*feature_columns()), lambda a, b: a * b / F.lit(float(UNIT))),
                      F.lit(0.0), lambda s, x: s + x)
    beyond = F.greatest(F.datediff("price_date", "last_date") / F.col("span"), F.lit(0.0))
    half = F.lit(Z80) * F.sqrt(F.col("noise") + F.lit(2.0 * CHANGEPOINTS / 3.0) * F.col("drift") * F.col("drift")
                               * beyond * beyond * beyond) * F.col("scale")
    out = rows.select("product", "product_name", "price_date", "step", F.col("y").alias("actual_price"),
                      (fit * F.col("scale")).alias("fit"), (-half).alias("lo"), half.alias("hi"))
    if simulate:
        q = (simulated_draws(fits, cfg, draws, seed).groupBy("product", "step")
             .agg(F.percentile("deviation", F.array(*map(F.lit, QUANTILES))).alias("q")))
        out = (out.join(q, ["product", "step"], "left")
               .withColumns({"lo": F.coalesce(F.col("q")[0], "lo"), "hi": F.coalesce(F.col("q")[1], "hi")}))
    return out.select("*", F.round("fit", 6).alias("forecast_price"),
                      F.round(F.col("fit") + F.col("lo"), 6).alias("forecast_lower"),
                      F.round(F.col("fit") + F.col("hi"), 6).alias("forecast_upper"),
                      F.col("actual_price").isNull().alias("is_forecast")).select(*FORECAST_COLUMNS)
