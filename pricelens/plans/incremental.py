"""Incremental layers: a batch of records moves through bronze, silver and gold,
and each layer rewrites only the partitions the batch can change.

All layers are versioned tables (``sources.versions``) partitioned by ``block``,
a run of ``block_days`` days.  For a batch:

1. bronze merges it by record key into the blocks of its periods;
2. silver is typed anew from these bronze blocks, so a record whose value is
   no longer readable leaves silver;
3. each gold table is widened by its lookback: a row that came, changed or went
   alters the rows after it up to the lookback, so later blocks are touched
   while fewer rows than that lie between.  The touched blocks are computed
   from their own rows and a halo of earlier ones, and replace their partitions.

How far to widen comes from row counts by (series, block), one scan of the key
columns of silver; the values are read for the touched blocks and their halo
only.  Every table keeps the batch numbers it has, so a run that died between
two tables is repeated whole, and what is already done is skipped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.config import DEFAULT, Config
from pricelens.operators import series as sr
from pricelens.operators import silver as sv
from pricelens.operators.blocks import BLOCK, BLOCK_DAYS, day_block, reached_blocks
from pricelens.session import materialize
from pricelens.sources import pages as pg
from pricelens.sources.versions import VersionedTable

RECORD_KEY = ["block", "period", "product", "duoarea", "series"]


@dataclass(frozen=True)
class GoldTable:
    """How a gold table follows from silver rows."""

    keys: tuple[str, ...]
    lookback: int
    rows: Callable[[DataFrame, Config], DataFrame]  # the silver rows it uses
    build: Callable[[DataFrame, Config, int, DataFrame | None], DataFrame]


GOLD = {
    "weekly": GoldTable(("product",), sr.WEEKLY_LOOKBACK - 1, sr.national_rows, sr.weekly_summary_blocked),
    "regional": GoldTable(("product", "duoarea"), 1, sr.regional_rows, sr.regional_comparison_blocked),
}


class IncrementalLayers:
    """Bronze, silver and gold tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, cfg: Config = DEFAULT, block_days: int = BLOCK_DAYS,
                 gold: dict[str, GoldTable] | None = None):
        self.spark, self.cfg, self.days, self.specs = spark, cfg, block_days, GOLD if gold is None else gold
        self.bronze, self.silver = (VersionedTable(spark, f"{root}/{n}", "block") for n in ("bronze", "silver"))
        self.gold = {n: VersionedTable(spark, f"{root}/gold_{n}", "block") for n in self.specs}

    def load(self, records: DataFrame, batch: int, as_of=None, writer: str = "load") -> dict[str, list]:
        """Bring one batch of raw records in.  Returns the touched blocks of
        each table.  Batches come in order; one that is in already is skipped."""
        mark = (writer, batch)
        day = F.col("period").try_cast("date")
        new = pg.bronze_records(records, self.cfg, as_of).withColumn("block", day_block(day, self.days))
        new = materialize(new)
        touched = {"bronze": _values(new, "block")}
        if not touched["bronze"]:
            return {n: [] for n in ("bronze", "silver", *self.gold)}
        self.bronze.merge(new, RECORD_KEY, batch=mark)
        typed = sv.silver_prices(self.bronze.read(values=touched["bronze"]), self.cfg)
        self.silver.replace_partitions(typed.withColumn("block", day_block("price_date", self.days)),
                                       touched["bronze"], batch=mark)
        touched["silver"] = touched["bronze"]
        for name, spec in self.specs.items():
            touched[name] = self._refresh(spec, self.gold[name], new, mark)
        return touched

    def _refresh(self, spec: GoldTable, table: VersionedTable, batch: DataFrame, mark: tuple[str, int]) -> list:
        keys = list(spec.keys)
        counted = spec.rows(self.silver.read(), self.cfg).withColumn(BLOCK, day_block("price_date", self.days))
        changed = batch.select(*keys, F.col("block").alias(BLOCK)).distinct()
        reached = materialize(reached_blocks(counted, changed, keys, spec.lookback))
        blocks = _values(reached, BLOCK)
        halo = reached_blocks(counted, counted.filter(F.col(BLOCK).isin(blocks)), keys, spec.lookback, backward=True)
        source = self.silver.read(values=sorted({*blocks, *_values(halo, BLOCK)}))
        targets = (spec.rows(source, self.cfg).withColumn(BLOCK, day_block("price_date", self.days))
                   .filter(F.col(BLOCK).isin(blocks)).select(*keys, BLOCK).distinct())
        rows = spec.build(source, self.cfg, self.days, targets)
        table.replace_partitions(rows.withColumn("block", day_block("price_date", self.days)), blocks, batch=mark)
        return blocks

    def read(self, name: str) -> DataFrame:
        """A gold table by its name, without the block column."""
        return self.gold[name].read().drop("block")


def _values(df: DataFrame, column: str) -> list:
    """Distinct block numbers, which are names of partitions."""
    return sorted(r[0] for r in df.select(column).distinct().collect())
