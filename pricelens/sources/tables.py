"""Table layer: namespaces, checked overwrite sink, views, keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.config import (
    DEFAULT,
    STORED_BASELINE,
    STORED_CALIBRATED,
    STORED_MODEL,
    STORED_RATE,
    Config,
)
from pricelens.sources.evolution import conform, reconcile

SURCHARGE_CONFIG_SCHEMA = T.StructType([
    T.StructField("baseline_fuel_price", T.DoubleType()),
    T.StructField("surcharge_rate", T.DoubleType()),
    T.StructField("surcharge_model", T.StringType()),
    T.StructField("last_calibrated", T.StringType()),
])
ZONE_COLUMNS = (
    "duoarea", "zone_name", "padd_region", "deliveries_per_week",
    "avg_miles_per_delivery", "revenue_per_delivery", "base_cost_per_delivery",
    "latitude", "longitude", "fleet_mpg",
)


def ensure_namespaces(spark: SparkSession, cfg: Config = DEFAULT) -> list[str]:
    """CREATE DATABASE IF NOT EXISTS for the bronze, silver and gold layers."""
    names = [cfg.database(layer) for layer in ("bronze", "silver", "gold")]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return names


def write_table(df: DataFrame, name: str, evolve: bool | str = False,
                partition_by: list[str] | None = None) -> int:
    """Full-refresh sink.  Returns the written row count, measured by an
    ``observe`` metric during the write instead of a second scan.

    ``evolve`` says what may become of an existing table's schema: ``False``
    refuses any change, ``"reconcile"`` lets columns be added or widened and
    keeps those that are missing (see ``evolution``), ``True`` replaces it.
    """
    spark = df.sparkSession
    if evolve is not True and spark.catalog.tableExists(name):
        old = spark.table(name).schema
        by_name = {f.name: f.dataType for f in old}
        if by_name != {f.name: f.dataType for f in df.schema}:
            if evolve != "reconcile":
                raise ValueError(f"schema of {name} would change; pass evolve to allow it")
            df = conform(df, reconcile(T.StructType([f for f in old]), df.schema))
        elif not evolve and [f.name for f in old] != df.columns and not partition_by:
            raise ValueError(f"column order of {name} would change; pass evolve to allow it")
    obs = Observation(f"write_{name.replace('.', '_')}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return int(obs.get["rows"])


def merge_partitions(updates: DataFrame, table: str, keys: list[str], partition_col: str,
                     order_col: str = "_ingested_at") -> int:
    """Keyed upsert of ``updates`` into a table partitioned by
    ``partition_col``, rewriting only the partitions the updates touch.

    The touched partitions are read (a semi join on the partition column,
    pruned to those partitions), merged with ``keyed_upsert`` and written to
    a staging table; the staging rows then replace exactly those partitions
    (dynamic partition overwrite).  Untouched partitions are never read or
    written, so the cost follows the batch, not the table.

    A table partitioned otherwise is refused: overwriting its partitions
    would remove rows that the batch does not replace.  Versions of a key
    within one batch, the first one included, are merged by the same rule
    (the greatest ``order_col``, then the greatest remaining fields).
    """
    spark = updates.sparkSession
    if not spark.catalog.tableExists(table):
        first = keyed_upsert(updates.limit(0), updates, keys, order_col)
        return write_table(first, table, evolve=True, partition_by=[partition_col])
    spark.catalog.refreshTable(table)
    split = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if split != [partition_col]:
        raise ValueError(f"{table} is partitioned by {split}, not by {partition_col}")
    current = spark.table(table)
    touched = updates.select(partition_col).distinct()
    affected = current.join(touched, partition_col, "left_semi")
    merged = keyed_upsert(affected, updates.select(*current.columns), keys, order_col)
    staging = f"{table}__merge"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    rows = write_table(merged, staging, evolve=True)
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.table(staging).select(*current.columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    spark.catalog.refreshTable(table)
    return rows


def keyed_upsert(current: DataFrame, updates: DataFrame, keys: list[str],
                 order_col: str = "_ingested_at") -> DataFrame:
    """Merge ``updates`` into ``current``: per key the row with the greatest
    ``order_col`` wins (ties: greatest remaining fields).

    Implemented as one hash aggregation of ``max(struct(order, payload))``:
    it combines map-side, so a key with very many versions is reduced
    before the shuffle instead of being sorted in one window partition.
    """
    cols = current.columns
    payload = [c for c in cols if c not in keys and c != order_col]
    q = lambda c: F.col(f"`{c}`")
    merged = current.unionByName(updates)
    best = merged.groupBy(*[q(k) for k in keys]).agg(
        F.max(F.struct(q(order_col).alias("_o"), *[q(c).alias(f"_p{i}") for i, c in enumerate(payload)])).alias("_best"))
    out = best.select(
        *[q(k) for k in keys],
        F.col("_best._o").alias(order_col),
        *[F.col(f"_best._p{i}").alias(c) for i, c in enumerate(payload)])
    return out.select(*[q(c) for c in cols])


def surcharge_config_frame(spark: SparkSession, baseline: float = STORED_BASELINE,
                           rate: float = STORED_RATE, model: str = STORED_MODEL,
                           calibrated: str = STORED_CALIBRATED) -> DataFrame:
    """The one-row surcharge configuration table (inline, declared schema)."""
    return spark.createDataFrame([(float(baseline), float(rate), model, calibrated)],
                                 SURCHARGE_CONFIG_SCHEMA)


def require_zone_columns(zones: DataFrame) -> DataFrame:
    """Zones must carry every column of the zone contract, ``padd_region``
    included (the margin join needs it)."""
    missing = [c for c in ZONE_COLUMNS if c not in zones.columns]
    if missing:
        raise ValueError(f"delivery zones lack columns: {', '.join(missing)}")
    return zones
