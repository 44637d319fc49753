import datetime as dt

from pyspark.sql import types as T

from pricelens.operators.silver import SILVER_COLUMNS

SILVER_SCHEMA = T.StructType([
    T.StructField("price_date", T.DateType()),
    T.StructField("product", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("duoarea", T.StringType()),
    T.StructField("area_name", T.StringType()),
    T.StructField("price_per_gallon", T.DoubleType()),
    T.StructField("series", T.StringType()),
    T.StructField("series_description", T.StringType()),
    T.StructField("units", T.StringType()),
])
assert tuple(f.name for f in SILVER_SCHEMA) == SILVER_COLUMNS

MONDAY = dt.date(2024, 1, 1)  # a Monday


def week(i: int) -> dt.date:
    return MONDAY + dt.timedelta(days=7 * i)


def silver_rows(product, prices, area="U.S.", duoarea="NUS", name=None, start=0, skip=()):
    name = name or {"EPMR": "Regular Gasoline", "EPD2DXL0": "No 2 Diesel Ultra Low Sulfur",
                    "EPM0": "Total Gasoline", "EPMP": "Premium Gasoline"}.get(product, product)
    cat = "Diesel" if product.startswith("EPD") else "Gasoline"
    out = []
    for i, p in enumerate(prices):
        if i in skip:
            continue
        out.append((week(start + i), product, name, cat, duoarea, area, p,
                    f"{product}_{duoarea}", f"{area} {name}", "$/GAL"))
    return out


def silver_df(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def half_up(x, n):
    """The library's rounding rule: decimal value at 8 places, then half-up."""
    from decimal import ROUND_HALF_UP, Decimal
    if x is None:
        return None
    d = Decimal(repr(float(x))).quantize(Decimal("1e-8"), ROUND_HALF_UP)
    return float(d.quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))
