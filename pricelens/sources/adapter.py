"""Driver tables -> raw weekly price records, delivery zones and state bridge.

The test tables hold orders, not fuel prices, so the price series the
library works on are derived from them:

* product  <- part type (fixed mapping below); one type maps to a product
  outside the tracked set so the source-side product filter has work to do;
* area     <- the supplier's region (supplier -> nation -> region), plus a
  national row over all suppliers;
* period   <- Monday of the ship date;
* value    <- sum(extendedprice) / sum(quantity) / 1000, 3 places, as text.

Plan shape (what keeps it cheap at scale): line items are projected to five
columns and both key maps (part -> product, supplier -> region) are joined
first, so the one aggregation runs on (product, region, week), a key with a
few thousand values: partial aggregation reduces every scan task to a few
rows before the only shuffle of line-item-derived data.  Aggregating on
(product, supplier, week) first would not reduce TPC-H-shaped data (well
under one line item per supplier-week).  Every join is left to the planner
(broadcast by file size, sort-merge on the key, or AQE's runtime broadcast;
AQE skew-join splits a hot part or supplier key).  The national row is a
second grouping over the few aggregated regional rows, so a filter on the
area (national only, one region) never forks the plan into two scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions.dates import week_start
from pricelens.functions.numeric import round_exact

# Part type -> product code, product code -> product name,
# and the constant text fields of a price record.
TYPE_TO_PRODUCT = {
    "STANDARD": "EPMR",
    "PROMO": "EPD2DXL0",
    "LARGE": "EPM0",
    "ECONOMY": "EPMP",
    "MEDIUM": "EPD2D",
    "SMALL": "EPLLPA",
}
PRODUCT_NAMES = {
    "EPMR": "Regular Gasoline",
    "EPD2DXL0": "No 2 Diesel Ultra Low Sulfur (0-15 ppm)",
    "EPM0": "Total Gasoline",
    "EPMP": "Premium Gasoline",
    "EPD2D": "No 2 Diesel",
    "EPLLPA": "Propane",
}
NATIONAL_DUOAREA = "NUS"
NATIONAL_AREA_NAME = "U.S."
PROCESS_NAME = "Retail Sales"
UNITS = "$/GAL"

# Order of the raw record fields (all text), as a page carries them.
RECORD_FIELDS = (
    "period", "duoarea", "area-name", "product", "product-name",
    "process-name", "series", "series-description", "value", "units",
)


# Declared read schemas of the driver tables (only the columns used): no
# footer inference per read, and a type drift fails loudly at the scan.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, sf_dir, n) for n in names]


def _map_expr(column: str, mapping: dict[str, str]) -> Column:
    """``CASE column WHEN key THEN value ... END`` for a fixed text mapping,
    built as one expression (one call to the JVM instead of one per arm)."""
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return F.expr(f"CASE `{column}` {arms} END")


def price_records(spark: SparkSession, sf_dir: str, products=None) -> DataFrame:
    """Raw price records, regional and national rows.

    ``products`` is the source-side product facet: only those products are
    produced (all when None).  It becomes an ``IN`` filter on the part scan,
    below both joins, so line items of other products are dropped before
    they are shuffled (Spark's runtime bloom filter carries the part-side
    filter to the line-item scan when the join is a shuffle join).
    """
    lineitem, part, supplier, nation, region = _tables(
        spark, sf_dir, "lineitem", "part", "supplier", "nation", "region")

    # Money as integer cents and quantities as integers: exact, order-free
    # sums without a per-row decimal conversion.
    items = lineitem.select(
        "l_partkey", "l_suppkey",
        week_start(F.col("l_shipdate")).alias("week"),
        F.floor(F.col("l_extendedprice") * F.lit(100.0) + F.lit(0.5)).alias("cents"),
        F.floor(F.col("l_quantity") + F.lit(0.5)).alias("qty"),
    )
    # The product travels through the shuffles as a small integer code and
    # becomes text only after the aggregation.
    codes = list(dict.fromkeys(TYPE_TO_PRODUCT.values()))
    type_code = {t: str(codes.index(p)) for t, p in TYPE_TO_PRODUCT.items()}
    if products is not None:
        part = part.filter(F.col("p_type").isin(
            [t for t, p in TYPE_TO_PRODUCT.items() if p in set(products)]))
    products = part.select(
        "p_partkey", _map_expr("p_type", type_code).cast("tinyint").alias("pcode"))
    # The supplier join goes to the plain supplier scan, whose size Spark
    # estimates from its files: broadcast when small, sort-merge on the
    # supplier key when large.  (Joining supplier to nation and region first
    # would give a join-of-joins estimate that never broadcasts.)  The same
    # holds for nation and region.
    suppliers = supplier.select("s_suppkey", "s_nationkey")
    # Both key maps are resolved before aggregating, so the aggregation key
    # is (product, region, week): partial aggregation collapses the line
    # items map-side and only a few rows per task reach the shuffle.  The
    # national row (all regions) is then folded from the few regional rows;
    # the integer sums make that exact.
    joined = (items.join(products, items.l_partkey == products.p_partkey)
              .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(nation.select("n_nationkey", "n_regionkey"),
                    F.col("s_nationkey") == F.col("n_nationkey"))
              .join(region.select("r_regionkey", "r_name"),
                    F.col("n_regionkey") == F.col("r_regionkey")))
    regional = (joined.groupBy("pcode", "r_regionkey", "r_name", "week")
                .agg(F.sum("cents").alias("cents"), F.sum("qty").alias("qty")))
    sets = regional.groupingSets(
        [["pcode", "r_regionkey", "r_name", "week"], ["pcode", "week"]],
        "pcode", "r_regionkey", "r_name", "week",
    ).agg(F.sum("cents").alias("cents"), F.sum("qty").alias("qty"),
          F.grouping("r_regionkey").alias("_national"))
    national = F.col("_national") == 1
    product = F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("pcode").cast("int") + 1)
    return _to_records(sets.select(
        product.alias("product"),
        F.when(national, F.lit(NATIONAL_DUOAREA))
        .otherwise(F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))).alias("duoarea"),
        F.when(national, F.lit(NATIONAL_AREA_NAME)).otherwise(F.col("r_name")).alias("area_name"),
        F.when(national, F.lit(-1)).otherwise(F.col("r_regionkey")).cast("int").alias("rk"),
        "week", "cents", "qty"))


def _to_records(agg: DataFrame) -> DataFrame:
    price = round_exact(
        F.col("cents").cast("double") / F.col("qty").cast("double") / F.lit(100000.0), 3)
    iso_week = F.weekofyear("week")
    # Deterministic malformed values so that the typed layer has rejects:
    # a missing value in ISO week 53, unparsable text in week 1 of region 4.
    value = (F.when(iso_week == 53, F.lit(None).cast("string"))
             .when((F.col("rk") == 4) & (iso_week == 1), F.lit("n/a"))
             .otherwise(price.cast("decimal(10,3)").cast("string")))
    name = _map_expr("product", PRODUCT_NAMES)
    return agg.select(
        F.date_format("week", "yyyy-MM-dd").alias("period"),
        F.col("duoarea"),
        F.col("area_name").alias("area-name"),
        F.col("product"),
        name.alias("product-name"),
        F.lit(PROCESS_NAME).alias("process-name"),
        F.concat_ws("_", F.col("product"), F.col("duoarea")).alias("series"),
        F.concat_ws(" ", F.col("area_name"), name, F.lit("Retail Price")).alias("series-description"),
        value.alias("value"),
        F.lit(UNITS).alias("units"),
    )


def delivery_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery zone per customer, priced against its nation's region."""
    customer, nation = _tables(spark, sf_dir, "customer", "nation")
    k = F.col("c_custkey")
    return (
        customer.select("c_custkey", "c_name", "c_nationkey")
        .join(nation.select("n_nationkey", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("Z"), k.cast("string")).alias("duoarea"),
            F.col("c_name").alias("zone_name"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("padd_region"),
            (F.lit(1) + k % 900).cast("int").alias("deliveries_per_week"),
            (F.lit(1) + k % 60).cast("int").alias("avg_miles_per_delivery"),
            (F.lit(200.0) + (k % 90).cast("double")).alias("revenue_per_delivery"),
            (F.lit(100.0) + (k % 80).cast("double")).alias("base_cost_per_delivery"),
            (F.lit(25.0) + (k % 24).cast("double")).alias("latitude"),
            (F.lit(-125.0) + (k % 58).cast("double")).alias("longitude"),
            F.lit(6.2).alias("fleet_mpg"),
        )
    )


def zone_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone -> list of state codes (two per zone, duplicates removed)."""
    customer, = _tables(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    code = lambda x: F.lpad((x % 50).cast("string"), 2, "0")
    return customer.select(
        F.concat(F.lit("Z"), k.cast("string")).alias("duoarea"),
        F.array_distinct(F.array(code(k), code(k * 7))).alias("states"),
    )
