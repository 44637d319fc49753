import datetime as dt

from pyspark.sql import functions as F

from pricelens.functions import (
    direction,
    exact_mean,
    floor_zero,
    future_weeks,
    js_round,
    minmax_position,
    nullif_zero,
    pct_change,
    round_exact,
    week_start,
)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_round_exact_half_up_on_decimal_value(spark):
    r = one(spark, round_exact(F.lit(1.005), 2).alias("a"), round_exact(F.lit(2.675), 2).alias("b"),
            round_exact(F.lit(-1.005), 2).alias("c"), round_exact(F.lit(0.12345), 4).alias("d"),
            round_exact(F.lit(None).cast("double"), 2).alias("e"))
    assert (r.a, r.b, r.c, r.d, r.e) == (1.01, 2.68, -1.01, 0.1235, None)


def test_round_exact_nan_is_null(spark):
    assert one(spark, round_exact(F.lit(float("nan")), 2).alias("x")).x is None


def test_js_round_halves_toward_plus_infinity(spark):
    r = one(spark, js_round(F.lit(2.5)).alias("a"), js_round(F.lit(-2.5)).alias("b"),
            js_round(F.lit(-2.6)).alias("c"), js_round(F.lit(0.49)).alias("d"))
    assert (r.a, r.b, r.c, r.d) == (3.0, -2.0, -3.0, 0.0)


def test_floor_zero_keeps_null(spark):
    r = one(spark, floor_zero(F.lit(-1.0)).alias("a"), floor_zero(F.lit(2.0)).alias("b"),
            floor_zero(F.lit(None).cast("double")).alias("c"))
    assert (r.a, r.b, r.c) == (0.0, 2.0, None)


def test_pct_change_zero_and_null_previous(spark):
    r = one(spark, pct_change(F.lit(2.0), F.lit(0.0)).alias("a"),
            pct_change(F.lit(2.0), F.lit(None).cast("double")).alias("b"),
            pct_change(F.lit(3.0), F.lit(2.0)).alias("c"))
    assert (r.a, r.b, r.c) == (None, None, 50.0)


def test_direction_labels(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,)], "x double")
    got = [r.d for r in df.select(direction("x").alias("d")).collect()]
    assert got == ["up", "down", "flat", None]
    got = [r.d for r in df.select(direction("x", "flat").alias("d")).collect()]
    assert got == ["up", "down", "flat", "flat"]


def test_minmax_position_equal_bounds_is_null(spark):
    r = one(spark, minmax_position(F.lit(2.0), F.lit(2.0), F.lit(2.0)).alias("a"),
            minmax_position(F.lit(3.0), F.lit(2.0), F.lit(4.0)).alias("b"))
    assert (r.a, r.b) == (None, 50.0)


def test_nullif_zero_and_exact_mean(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    # exact decimal sum 0.6, divided as doubles
    assert df.agg(exact_mean("x").alias("m")).first().m == 0.6 / 3.0
    empty = df.filter("x > 5").agg(exact_mean("x").alias("m")).first().m
    assert empty is None
    assert one(spark, nullif_zero(F.lit(0.0)).alias("z")).z is None


def test_week_start_and_future_weeks(spark):
    r = one(spark, week_start(F.lit("2001-11-04 10:00:00").cast("timestamp")).alias("w"),
            future_weeks(F.lit("2024-01-01").cast("date"), 3).alias("f"),
            future_weeks(F.lit("2024-01-07").cast("date"), 2).alias("g"))
    assert r.w == dt.date(2001, 10, 29)
    assert r.f == [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 21)]
    # a Sunday last date: the next Sunday, strictly after
    assert r.g == [dt.date(2024, 1, 14), dt.date(2024, 1, 21)]
