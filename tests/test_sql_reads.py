import datetime as dt

import pytest
from pyspark.errors import PySparkException

from pricelens.config import Config
from pricelens.operators import forecast as fc
from pricelens.operators import reads as rd
from pricelens.operators.series import regional_comparison, weekly_summary
from pricelens.plans.sql_reads import register_sql_reads

from helpers import silver_df, silver_rows, week

DIESEL = "EPD2DXL0"


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("gold")
    national = silver_df(spark, silver_rows("EPMR", [2 + 0.01 * i for i in range(90)])
                         + silver_rows(DIESEL, [3 + 0.02 * i for i in range(80)]))
    areas = silver_df(spark, [r for area, code, n in (("U.S.", "NUS", 30), ("PADD 1", "R10", 30), ("PADD 2", "R20", 29),
                                                      ("PADD 3", "R30", 30))
                              for r in silver_rows(DIESEL, [3 + 0.1 * k for k in range(n)], area=area, duoarea=code)])
    weekly = weekly_summary(national)
    frames = {"weekly": weekly, "regional": regional_comparison(areas), "forecast": fc.linear_seasonal_forecast(weekly)}
    read = {}
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
        read[name] = spark.read.parquet(f"{folder}/{name}")
        read[name].createOrReplaceTempView(f"t_{name}")
    register_sql_reads(spark, "t_weekly", "t_regional", "t_forecast")
    return read


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def ask(spark, text, **args):
    return spark.sql(f"SELECT * FROM {text}", args=args)


@pytest.mark.parametrize("weeks", [1, 52, 9999, 0, -4])
def test_trends_with_bound_and_clamped_weeks(spark, gold, weeks):
    got = ask(spark, "price_trends(:p, :n)", p="EPMR", n=weeks)
    assert rows(got) == rows(rd.trends(gold["weekly"], "EPMR", weeks))
    assert rows(ask(spark, "price_trends(:p)", p="EPMR")) == rows(rd.trends(gold["weekly"], "EPMR", 52))


def test_regional_at_the_products_latest_date(spark, gold):
    got = ask(spark, "price_regional(:p)", p=DIESEL)
    assert rows(got) == rows(rd.regional_latest(gold["regional"], DIESEL))
    assert got.count() == 2  # the lagging area and the national row are out
    assert ask(spark, "price_regional(:p)", p="EPMR").count() == 0


def test_forecast_windows(spark, gold):
    f = gold["forecast"]
    assert rows(ask(spark, "price_forecast_latest(:p, :d)", p=DIESEL, d=60)) == rows(
        fc.forecast_window(f, DIESEL, fc.LATEST_ACTUAL, 60))
    day = week(50)
    assert rows(ask(spark, "price_forecast(:p, :a)", p=DIESEL, a=day)) == rows(fc.forecast_window(f, DIESEL, day))
    assert ask(spark, "price_forecast(:p, CAST(NULL AS DATE))", p=DIESEL).count() == fc.forecast_window(
        f, DIESEL, None).count()
    assert isinstance(day, dt.date)


@pytest.mark.parametrize("call", ["price_trends(:p, 5)", "price_regional(:p)", "price_forecast_latest(:p)",
                                  "price_forecast(:p, DATE'2024-01-01')"])
@pytest.mark.parametrize("product", ["NOPE", "EPMR' OR '1'='1", "", None])
def test_unknown_products_fail(spark, gold, call, product):
    with pytest.raises(PySparkException, match="unknown product"):
        ask(spark, call, p=product).collect()


def test_null_weeks_fail(spark, gold):
    with pytest.raises(PySparkException, match="weeks is null"):
        ask(spark, "price_trends(:p, CAST(NULL AS INT))", p="EPMR").collect()


@pytest.mark.parametrize("call", ["price_trends(:p, 5)", "price_regional(:p)", "price_forecast_latest(:p)",
                                  "price_forecast(:p, DATE'2024-01-01')"])
def test_the_product_is_pushed_to_the_scan(spark, gold, call):
    plan = ask(spark, call, p=DIESEL)._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(product,{DIESEL})" in plan
    assert "raise_error" not in plan


def test_arguments_come_from_a_query_too(spark, gold):
    got = spark.sql("SELECT x.p, t.price_date FROM VALUES ('EPMR'), ('EPD2DXL0') AS x(p), LATERAL price_trends(x.p, 2) t")
    assert got.groupBy("p").count().count() == 2 and got.count() == 4


def test_default_relations_are_the_gold_tables(spark):
    with pytest.raises(PySparkException, match="nowhere_gold"):
        register_sql_reads(spark, cfg=Config(catalog="nowhere"))
        spark.sql("SELECT * FROM price_trends('EPMR')").collect()
