"""Row-based windows over very long series, block by block.

A lag or trailing mean looks back over the ``lookback`` rows before a row.  A
window partitioned by series puts a whole series into one task; here a series
is cut into blocks of its order column, and every block gets a halo: the last
``lookback`` rows of the series before it.  Windows partitioned by (series,
block) over block and halo give the same values, and tasks are as many as
blocks.

The halo comes from the blocks' tails: the last ``lookback`` rows of each block
(a rank that is cut inside each task before the shuffle).  The rows before a
block that count are among the tails of the blocks before it, whatever the
gaps: counted along the tails of a series, tail row r is in the halo of a later
block when fewer than ``lookback`` tail rows lie between.  That is at most the
next ``lookback`` blocks that have rows.  Tails are lookback x blocks rows of a
series, so this step is small against the series.

Rows that share series and order value have no defined order, here as in a
plain window.  Rows without an order value form a block of their own, which
comes first, as nulls do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

BLOCK_DAYS = 364  # 52 weeks
BLOCK, HALO = "_block", "_halo"


def day_block(order: str | Column = "price_date", days: int = BLOCK_DAYS) -> Column:
    """Number of the run of ``days`` days a date lies in; -2**40 without a date."""
    return F.coalesce(F.floor(F.unix_date(order) / days), F.lit(-(1 << 40)))


def with_halo(df: DataFrame, keys: Sequence[str], order: str, lookback: int, block: Column,
              targets: DataFrame | None = None) -> DataFrame:
    """``df`` with ``_block`` and ``_halo``: every row once in its own block
    (false), and again in each later block whose halo it belongs to (true).

    ``targets`` (keys, _block): only these blocks and their halos."""
    rows = df.withColumn(BLOCK, block)
    own = rows if targets is None else rows.join(targets, [*keys, BLOCK], "left_semi")
    if lookback <= 0:
        return own.withColumn(HALO, F.lit(False))
    in_block = Window.partitionBy(*keys, BLOCK).orderBy(F.desc(order))
    tails = rows.withColumn("_back", F.row_number().over(in_block)).filter(F.col("_back") <= lookback)
    along = Window.partitionBy(*keys).orderBy(BLOCK, F.desc("_back"))
    tails = tails.withColumn("_r", F.row_number().over(along))
    # per block with rows: the later blocks, and how many tail rows lie before each
    ends = tails.groupBy(*keys, BLOCK).agg(F.max("_r").alias("_end"))
    ahead = F.collect_list(F.struct(F.col(BLOCK).alias("to"), F.col("_before").alias("before"))).over(
        Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(1, lookback))
    ends = ends.withColumn("_before", F.lag("_end", 1, 0).over(Window.partitionBy(*keys).orderBy(BLOCK)))
    ends = ends.withColumn("_ahead", ahead).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                                                   F.col(BLOCK).alias("_from"), "_ahead")
    same = F.col(BLOCK) == F.col("_from")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    halo = (tails.join(ends, same).withColumn("_x", F.explode("_ahead"))
            .filter(F.col("_x.before") - F.col("_r") < lookback)
            .withColumn(BLOCK, F.col("_x.to")).select(*rows.columns))
    if targets is not None:
        halo = halo.join(targets, [*keys, BLOCK], "left_semi")
    return own.withColumn(HALO, F.lit(False)).unionByName(halo.withColumn(HALO, F.lit(True)))


def blocked(df: DataFrame, keys: Sequence[str], order: str, lookback: int, block: Column,
            columns: Callable[[WindowSpec], dict[str, Column]], targets: DataFrame | None = None) -> DataFrame:
    """``df`` plus the columns that ``columns(window)`` builds over a window
    ordered by ``order`` that looks back ``lookback`` rows at most."""
    w = Window.partitionBy(*keys, BLOCK).orderBy(order)
    return (with_halo(df, keys, order, lookback, block, targets).withColumns(columns(w))
            .filter(~F.col(HALO)).drop(HALO, BLOCK))


def reached_blocks(rows: DataFrame, changed: DataFrame, keys: Sequence[str], lookback: int,
                   backward: bool = False) -> DataFrame:
    """(keys, _block): the blocks whose values may differ after rows in the
    ``changed`` (keys, _block) were added, revised or removed: these, and later
    blocks while fewer than ``lookback`` rows of ``rows`` lie between.
    ``backward``: instead the earlier blocks that their halos come from."""
    changed = changed.select(*keys, BLOCK).distinct()
    sizes = (rows.groupBy(*keys, BLOCK).agg(F.count("*").alias("n"))
             .unionByName(changed.withColumn("n", F.lit(0).cast("long")))
             .groupBy(*keys, BLOCK).agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 0).alias("_c")))
    w = Window.partitionBy(*keys).orderBy(F.desc(BLOCK) if backward else BLOCK)
    sizes = sizes.withColumn("_upto", F.sum("n").over(w))
    # rows up to and with the last changed block before or at this one
    last = F.max(F.when(F.col("_c") > 0, F.col("_upto"))).over(w)
    sizes = sizes.withColumn("_between", F.col("_upto") - F.col("n") - last)
    return sizes.filter((F.col("_c") > 0) | (F.col("_between") < lookback)).select(*keys, BLOCK)
