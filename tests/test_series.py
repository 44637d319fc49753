import random

from pyspark.sql import functions as F

from pricelens.operators.series import (
    duplicate_keys,
    latest,
    regional_comparison,
    weekly_summary,
)

from helpers import half_up, silver_df, silver_rows, week


def brute_weekly(prices):
    """Row-based reference computation for one series."""
    out = []
    for i, p in enumerate(prices):
        prev = prices[i - 1] if i >= 1 else None
        back4 = prices[i - 4] if i >= 4 else None
        a4 = prices[max(0, i - 3): i + 1]
        a12 = prices[max(0, i - 11): i + 1]
        out.append((p, prev, sum(a4) / len(a4), sum(a12) / len(a12), back4))
    return out


def test_weekly_summary_matches_brute_force(spark):
    prices = [round(2.0 + 0.013 * i + (0.05 if i % 3 == 0 else 0), 3) for i in range(14)]
    rows = silver_rows("EPMR", prices)
    random.Random(1).shuffle(rows)  # input order must not matter
    got = weekly_summary(silver_df(spark, rows)).orderBy("price_date").collect()
    exp = brute_weekly(prices)
    assert len(got) == 14
    for r, (p, prev, a4, a12, back4) in zip(got, exp):
        assert r.price_per_gallon == p and r.prev_week_price == prev and r.price_4wk_ago == back4
        assert r.avg_4wk == half_up(a4, 4)
        assert r.avg_12wk == half_up(a12, 4)
        if prev is None:
            assert r.wow_change is None and r.wow_pct_change is None
        else:
            assert r.wow_change == half_up(p - prev, 4)
            assert r.wow_pct_change == half_up((p - prev) / prev * 100, 2)
        if back4 is None:
            assert r.mom_change is None


def test_lags_are_by_row_across_a_gap(spark):
    rows = silver_rows("EPMR", [1.0, 2.0, 3.0, 4.0], skip=(2,))
    got = weekly_summary(silver_df(spark, rows)).orderBy("price_date").collect()
    assert [r.price_date for r in got] == [week(0), week(1), week(3)]
    assert got[2].prev_week_price == 2.0  # the row before, though a week is missing


def test_zero_previous_price_gives_null_pct(spark):
    rows = silver_rows("EPMR", [0.0, 1.5])
    got = weekly_summary(silver_df(spark, rows)).orderBy("price_date").collect()
    assert got[1].wow_pct_change is None and got[1].wow_change == 1.5


def test_single_row_series_and_filters(spark):
    rows = (silver_rows("EPMP", [3.0]) + silver_rows("EPD2D", [3.0, 3.1])
            + silver_rows("EPMR", [2.0, 2.1], area="AFRICA", duoarea="R0"))
    got = weekly_summary(silver_df(spark, rows)).collect()
    assert [(r.product, r.prev_week_price, r.avg_4wk) for r in got] == [("EPMP", None, 3.0)]


def test_half_rounding_of_means(spark):
    # mean of 1.0001 and 1.0002 is 1.00015: half-up at 4 places -> 1.0002
    got = weekly_summary(silver_df(spark, silver_rows("EPMR", [1.0001, 1.0002]))).orderBy("price_date").collect()
    assert got[1].avg_4wk == 1.0002


def test_regional_keeps_national_and_lags_per_area(spark):
    rows = (silver_rows("EPD2DXL0", [3.0, 3.2]) + silver_rows("EPD2DXL0", [4.0, 3.9], area="EAST", duoarea="R1")
            + silver_rows("EPM0", [1.0, 2.0], area="EAST", duoarea="R1"))
    got = regional_comparison(silver_df(spark, rows)).orderBy("duoarea", "price_date").collect()
    assert [(r.duoarea, r.prev_week_price, r.wow_change) for r in got] == [
        ("NUS", None, None), ("NUS", 3.0, 0.2), ("R1", None, None), ("R1", 4.0, -0.1)]


def test_duplicate_dates_are_detected(spark):
    rows = silver_rows("EPMR", [1.0, 2.0]) + silver_rows("EPMR", [1.1])
    dup = duplicate_keys(silver_df(spark, rows), ["product", "duoarea"]).collect()
    assert [(r.price_date, r.n) for r in dup] == [(week(0), 2)]


def test_latest_scopes(spark):
    rows = silver_rows("EPMR", [1.0, 2.0, 3.0]) + silver_rows("EPMP", [1.0, 2.0])
    df = silver_df(spark, rows)
    assert [r.product for r in latest(df).collect()] == ["EPMR"]
    per = sorted((r.product, r.price_date) for r in latest(df, ["product"]).collect())
    assert per == [("EPMP", week(1)), ("EPMR", week(2))]


def test_weekly_plan_has_one_exchange_and_one_window(spark):
    df = weekly_summary(silver_df(spark, silver_rows("EPMR", [1.0, 2.0])))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 or plan.count("Window ") >= 1
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("Window ") == 1
    assert F is not None


def test_newest_cut_equals_full_history_on_the_newest_week(spark):
    prices = [round(1.0 + 0.01 * i + (0.3 if i % 5 == 0 else 0), 3) for i in range(40)]
    rows = silver_rows("EPMR", prices) + silver_rows("EPM0", prices[:30])
    df = silver_df(spark, rows)
    full = weekly_summary(df)
    cut = weekly_summary(df, newest=1)
    newest = latest(full, ["product"])
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, newest.collect()))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_regional_newest_cut_keeps_every_latest_read(spark):
    rows = (silver_rows("EPD2DXL0", [3.0, 3.1, 3.3, 3.2]) + silver_rows("EPD2DXL0", [4.0, 4.2, 4.1], area="E", duoarea="R1")
            + silver_rows("EPMR", [2.0, 2.5, 2.4, 2.2, 2.9], area="E", duoarea="R1"))
    df = silver_df(spark, rows)
    full, cut = regional_comparison(df), regional_comparison(df, newest=1)
    expect = latest(full, ["product", "duoarea"])
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, expect.collect()))
