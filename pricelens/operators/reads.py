"""Read-side operators over the gold tables (B-02, B-06, B-07, B-10..B-12,
B-23, B-24, B-30, B-31).

"Latest" has three scopes and each read states its own:
* snapshot: the table-wide latest date (a lagging product drops out);
* regional reads and margins: latest per product over all areas (a lagging
  area drops out);
* the notebook check: latest over both regional products, then one product
  (may be empty).
Each is a rank that is cut inside every task before the shuffle (one pass,
never a collect).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.config import DEFAULT, PREVIEW_ROWS, Config
from pricelens.functions.numeric import direction, minmax_position
from pricelens.operators.series import latest


def validate_product(product: str, cfg: Config = DEFAULT) -> str:
    """``product`` if it is tracked; an unknown code is an error, since it
    would otherwise read as an empty series."""
    if product in cfg.ingest_products:
        return product
    raise ValueError(f"{product!r} is not among the tracked products {sorted(cfg.ingest_products)}")


def clamp_weeks(weeks, cfg: Config = DEFAULT) -> int:
    return max(1, min(int(weeks), cfg.max_trend_weeks))


def ingest_profile(bronze: DataFrame) -> DataFrame:
    """B-02: per product name, row count and first / last period."""
    return (bronze.groupBy("product-name")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.min("period").alias("earliest"),
                 F.max("period").alias("latest"))
            .orderBy("product-name"))


def snapshot(weekly: DataFrame) -> DataFrame:
    """B-06: weekly rows at the table-wide latest date."""
    return (latest(weekly)
            .select("product_name", "product_category", "price_per_gallon", "wow_change",
                    "wow_pct_change", "mom_change", "avg_4wk", "avg_12wk", "price_date",
                    "product")
            .orderBy("product_category", "product_name", "product"))


def trends(weekly: DataFrame, product: str = "EPMR", weeks=52, cfg: Config = DEFAULT) -> DataFrame:
    """B-07: newest ``weeks`` rows of one product (clamped to 1..520),
    returned oldest first.  The limit is the feature: a top-k per request."""
    product = validate_product(product, cfg)
    n = clamp_weeks(weeks, cfg)
    newest = (weekly.filter(F.col("product") == product)
              .select("price_date", "price_per_gallon", "wow_change", "wow_pct_change",
                      "avg_4wk", "avg_12wk")
              .orderBy(F.desc("price_date")).limit(n))
    return newest.orderBy("price_date")


def trends_per_product(weekly: DataFrame, weeks=52, cfg: Config = DEFAULT) -> DataFrame:
    """Newest ``weeks`` rows of every product at once (row_number <= n is
    planned as a partial + final WindowGroupLimit, so each series is cut
    to n rows before the shuffle)."""
    n = clamp_weeks(weeks, cfg)
    w = Window.partitionBy("product").orderBy(F.desc("price_date"))
    return (weekly.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n).drop("_rn"))


def regional_latest(regional: DataFrame, product: str = DEFAULT.diesel_product,
                    cfg: Config = DEFAULT) -> DataFrame:
    """B-10: areas at the product's latest date, national row excluded,
    dearest first (null area names drop, as with SQL's !=)."""
    product = validate_product(product, cfg)
    one = regional.filter(F.col("product") == product)
    return (latest(one)
            .filter(F.col("area_name") != cfg.national_area)
            .select("area_name", "duoarea", "price_per_gallon", "wow_change", "price_date",
                    "product")
            .orderBy(F.desc("price_per_gallon"), "duoarea"))


def regional_latest_each(regional: DataFrame, products: list[str] | None = None,
                         cfg: Config = DEFAULT) -> DataFrame:
    """B-10 for several products at once: each product at its own latest
    date, in one pass, national row excluded."""
    wanted = [validate_product(p, cfg) for p in (products or cfg.regional_products)]
    some = regional.filter(F.col("product").isin(wanted))
    return (latest(some, ["product"])
            .filter(F.col("area_name") != cfg.national_area)
            .select("area_name", "duoarea", "price_per_gallon", "wow_change", "price_date",
                    "product"))


def regional_latest_global(regional: DataFrame, product: str = DEFAULT.diesel_product) -> DataFrame:
    """B-11: one product at the table-wide latest date, cheapest first
    (empty when that product lags the other)."""
    return (latest(regional).filter(F.col("product") == product)
            .orderBy("price_per_gallon", "duoarea"))


def regional_position(latest_rows: DataFrame) -> DataFrame:
    """B-23: per area of a latest slice, relative position between the
    cheapest and dearest area (null when all are equal), direction and
    size of the weekly change, and the axis bounds of the bar chart.

    The window is per product over one date's areas, so it is bounded by
    the number of areas."""
    w = Window.partitionBy("product")
    lo, hi = F.min("price_per_gallon").over(w), F.max("price_per_gallon").over(w)
    return latest_rows.select(
        "product", "price_date", "duoarea", "area_name", "price_per_gallon", "wow_change",
        minmax_position("price_per_gallon", lo, hi).alias("position_pct"),
        direction("wow_change", null_label="flat").alias("direction"),
        F.abs("wow_change").alias("change_size"),
        (lo * F.lit(0.9)).alias("axis_min"),
        (hi * F.lit(1.02)).alias("axis_max"),
    )


def products(weekly: DataFrame) -> DataFrame:
    """B-12: distinct (product, name, category), by category then name."""
    return (weekly.select("product", "product_name", "product_category").distinct()
            .orderBy("product_category", "product_name", "product"))


def data_through(weekly: DataFrame) -> DataFrame:
    """A-10: the newest date in the weekly table (one row)."""
    return weekly.agg(F.max("price_date").alias("data_through"))


def snapshot_cards(snap: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """B-24: fixed-priority cards.  Slot i takes the first snapshot row (in
    category, name order) whose name contains the slot keyword; empty slots
    drop.  Slots come from an array of matches per row, exploded, and one
    ``min(struct)`` aggregation per slot: no join against a keyword table."""
    matches = F.array(*[F.when(F.col("product_name").contains(kw), F.lit(i))
                        for i, (_, kw) in enumerate(cfg.snapshot_slots)])
    payload = ["product_name", "product", "price_per_gallon", "wow_change", "wow_pct_change",
               "avg_4wk", "avg_12wk", "mom_change", "price_date"]
    slotted = snap.select(
        F.explode(F.filter(matches, lambda x: x.isNotNull())).alias("slot"),
        F.struct(F.col("product_category").alias("_k1"), F.col("product_name").alias("_k2"),
                 F.col("product").alias("_k3"), *[F.col(c) for c in payload]).alias("row"))
    best = slotted.groupBy("slot").agg(F.min("row").alias("row"))
    codes = F.array(*[F.lit(code) for code, _ in cfg.snapshot_slots])
    return best.select(
        F.col("slot").cast("int").alias("slot"),
        F.element_at(codes, F.col("slot") + 1).alias("slot_product"),
        *[F.col(f"row.{c}").alias(c) for c in payload],
        direction("row.wow_change").alias("wow_direction"),
        F.abs("row.wow_change").alias("wow_abs"),
        direction("row.wow_pct_change").alias("wow_pct_direction"),
        F.abs("row.wow_pct_change").alias("wow_pct_abs"),
    ).orderBy("slot")


def silver_preview(silver: DataFrame, cfg: Config = DEFAULT, n: int = PREVIEW_ROWS) -> DataFrame:
    """B-30: newest national rows of the regional products (a preview; the
    limit is the feature)."""
    return (silver.filter(F.col("area_name") == cfg.national_area)
            .filter(F.col("product").isin(list(cfg.regional_products)))
            .orderBy(F.desc("price_date"), "product", "series").limit(n))


def weekly_preview(weekly: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """B-31: newest weekly rows."""
    return weekly.orderBy(F.desc("price_date"), "product_name", "product").limit(n)
