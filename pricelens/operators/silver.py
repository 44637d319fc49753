"""Silver layer: typed, categorised, pruned price rows (B-03) and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.config import DEFAULT, Config

SILVER_COLUMNS = (
    "price_date", "product", "product_name", "product_category", "duoarea",
    "area_name", "price_per_gallon", "series", "series_description", "units",
)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every hyphenated column to snake case."""
    return df.withColumnsRenamed({c: c.replace("-", "_") for c in df.columns if "-" in c})


def product_category(product: Column, cfg: Config = DEFAULT) -> Column:
    """'Diesel' for codes with the diesel prefix, else 'Gasoline' (null too)."""
    return F.when(product.startswith(cfg.diesel_prefix), F.lit("Diesel")).otherwise(F.lit("Gasoline"))


def _typed(bronze: DataFrame, cfg: Config) -> DataFrame:
    # try_cast: malformed text (ANSI would raise) becomes null and is
    # counted as a reject instead of failing the whole load.
    return snake_case_columns(bronze).withColumns({
        "price_date": F.col("period").try_cast("date"),
        "price_per_gallon": F.col("value").try_cast("double"),
        "product_category": product_category(F.col("product"), cfg),
    })


def silver_prices(bronze: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rename, type, categorise, prune, and drop rows without a price or a
    date (``silver_rejects`` reports them)."""
    src = {c.replace("-", "_"): F.col(f"`{c}`") for c in bronze.columns}
    typed = {
        "price_date": F.col("period").try_cast("date"),
        "price_per_gallon": F.col("value").try_cast("double"),
        "product_category": product_category(F.col("product"), cfg),
    }
    return (bronze.select(*[(typed[c] if c in typed else src[c]).alias(c) for c in SILVER_COLUMNS])
            .filter(F.col("price_per_gallon").isNotNull() & F.col("price_date").isNotNull()))


def silver_rejects(bronze: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Bronze rows that silver drops or cannot date, with the reason."""
    typed = _typed(bronze, cfg)
    reason = (F.when(F.col("value").isNull(), F.lit("missing value"))
              .when(F.col("price_per_gallon").isNull(), F.lit("unparsable value"))
              .when(F.col("price_date").isNull(), F.lit("unparsable period")))
    return (typed.withColumn("reason", reason)
            .filter(F.col("reason").isNotNull())
            .select("period", "product", "duoarea", "series", "value", "reason"))
