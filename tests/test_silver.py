import datetime as dt

from pyspark.sql import types as T

from pricelens.operators.silver import SILVER_COLUMNS, silver_prices, silver_rejects
from pricelens.sources.pages import RECORD_SCHEMA


def bronze(spark, rows):
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def rec(period, product, value, area="U.S.", duoarea="NUS"):
    return (period, duoarea, area, product, f"name {product}", "Retail", f"{product}_{duoarea}",
            "desc", value, "$/GAL")


def test_silver_types_categorises_and_drops(spark):
    rows = [
        rec("2024-01-01", "EPD2D", "3.5"),
        rec("2024-01-08", "EPMR", None),          # null value: dropped
        rec("2024-01-15", "EPMR", "n/a"),         # unparsable: dropped
        rec("2026-13-01", "EPMR", "2.5"),         # bad date: dropped, a reject
        rec("2024-01-22", None, "2.75"),          # null product: Gasoline
        rec("2024-01-29", "EPD2DXL0", " 3.0 "),
    ]
    out = silver_prices(bronze(spark, rows)).orderBy("price_per_gallon").collect()
    assert tuple(out[0].asDict()) == SILVER_COLUMNS
    got = [(r.price_date, r.product, r.product_category, r.price_per_gallon) for r in out]
    assert got == [
        (dt.date(2024, 1, 22), None, "Gasoline", 2.75),
        (dt.date(2024, 1, 29), "EPD2DXL0", "Diesel", 3.0),
        (dt.date(2024, 1, 1), "EPD2D", "Diesel", 3.5),
    ]


def test_silver_rejects_reasons(spark):
    rows = [rec("2024-01-08", "EPMR", None), rec("2024-01-15", "EPMR", "n/a"),
            rec("2026-13-01", "EPMR", "2.5"), rec("2024-01-22", "EPMR", "2.0")]
    got = {(r.period, r.reason) for r in silver_rejects(bronze(spark, rows)).collect()}
    assert got == {("2024-01-08", "missing value"), ("2024-01-15", "unparsable value"),
                   ("2026-13-01", "unparsable period")}


def test_silver_schema_types(spark):
    schema = silver_prices(bronze(spark, [rec("2024-01-01", "EPMR", "1")])).schema
    assert schema["price_date"].dataType == T.DateType()
    assert schema["price_per_gallon"].dataType == T.DoubleType()
