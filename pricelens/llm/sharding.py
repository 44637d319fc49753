"""Best-fit-decreasing packing of indivisible groups into shards.

Groups (equal texts) sorted by size, largest first, enter the bin with the
tightest remaining capacity that still holds them, found in a balanced (AVL)
tree of (remaining capacity, bin).

``pack`` (fixed number of shards, near-equal bytes): the least capacity for
which best fit uses no more bins is searched upward from the mean.  The work
is split so that no task sees more than a bound of groups:

* The head, every group of at least total / ``head_groups`` bytes, holds
  at most ``head_groups`` groups by arithmetic; one task packs it.
* The tail is dealt by hash into cells of about ``cell_groups`` groups, packed
  in parallel.  A cell receives its share of the room that the head left in
  each bin and fills that; bins are level to within the smallest groups.

A group larger than a shard's mean (at most ``n_shards`` of them) cannot stay
whole and leave the shards level: its rows are dealt by a hash of the id over
pieces of an eighth of the mean, and only such a group spans shards.  A single
row larger than the mean takes a shard alone.

``pack_capacity`` (fixed capacity, few shards): cells are packed alone into
bins of the given capacity, and numbered one after the other; each cell has at
least ``cell_bins`` bins' worth of bytes, so at most one part-filled bin in
``cell_bins`` is lost.  A group above the capacity gets a shard of its own.

Null texts form one group, as do empty texts.  Repeated rows of one text are
one group; repeated ids get one row each.  An empty table gives no rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import lanes, table, utf8_bytes, written

ROW_OVERHEAD = 16
HEAD_GROUPS = 20_000
CELL_GROUPS = 50_000
CELL_BINS = 64
PIECES = 8


class RoomTree:
    """AVL tree of (room, bin): insert, and take the least room that fits."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # node: [key, left, right, height]

    @staticmethod
    def _level(n):
        left, right = n[1], n[2]
        hl, hr = left[3] if left else 0, right[3] if right else 0
        if hl > hr + 1:
            if (left[1][3] if left[1] else 0) < (left[2][3] if left[2] else 0):
                n[1] = RoomTree._turn(left, 2, 1)
            return RoomTree._turn(n, 1, 2)
        if hr > hl + 1:
            if (right[2][3] if right[2] else 0) < (right[1][3] if right[1] else 0):
                n[2] = RoomTree._turn(right, 1, 2)
            return RoomTree._turn(n, 2, 1)
        n[3] = 1 + max(hl, hr)
        return n

    @staticmethod
    def _turn(n, up, down):
        child = n[up]
        n[up], child[down] = child[down], n
        for x in (n, child):
            x[3] = 1 + max(x[1][3] if x[1] else 0, x[2][3] if x[2] else 0)
        return child

    def insert(self, key):
        def put(n):
            if n is None:
                return [key, None, None, 1]
            side = 1 if key < n[0] else 2
            n[side] = put(n[side])
            return self._level(n)
        self.root = put(self.root)

    def take(self, size):
        """Remove and return the least key with room >= size, or None."""
        n, best = self.root, None
        while n:
            if n[0][0] >= size:
                best, n = n[0], n[1]
            else:
                n = n[2]
        if best is not None:
            self.root = self._drop(self.root, best)
        return best

    def _drop(self, n, key):
        if key < n[0]:
            n[1] = self._drop(n[1], key)
        elif key > n[0]:
            n[2] = self._drop(n[2], key)
        elif n[1] is None or n[2] is None:
            return n[1] or n[2]
        else:
            least = n[2]
            while least[1]:
                least = least[1]
            n[0] = least[0]
            n[2] = self._drop(n[2], least[0])
        return self._level(n)


def best_fit(sizes: list[int], rooms: list[int], grow: int | None = None) -> list[int] | None:
    """Bin of each size (sizes in decreasing order).  ``rooms`` are the free
    capacities.  A size that fits nowhere opens a bin of capacity ``grow``
    (larger if the size is), or without ``grow`` makes the packing fail."""
    tree, out, n = RoomTree(), [], len(rooms)
    for k, room in enumerate(rooms):
        tree.insert((room, k))
    for s in sizes:
        got = tree.take(s)
        if got is None:
            if grow is None:
                return None
            got, n = (max(grow, s), n), n + 1
        out.append(got[1])
        tree.insert((got[0] - s, got[1]))
    return out


def level_fit(sizes: list[int], used: list[int]) -> list[int]:
    """Best fit into len(used) bins that already hold ``used``, with a common
    capacity: the first that fits among the water level and growing steps above
    it (not always the least); a bin above the capacity takes nothing."""
    if not sizes:
        return []
    total, bins = sum(sizes), len(used)
    low = sorted(used)
    level, filled = low[0], 0  # water level at which the free room equals the total
    for k in range(bins):
        top = low[k + 1] if k + 1 < bins else math.inf
        room = (top - low[k]) * (k + 1) if top < math.inf else math.inf
        if filled + room >= total:
            level = low[k] + -(-(total - filled) // (k + 1))
            break
        filled += room
    capacity, step = level, max(1, min(sizes))
    while True:
        got = best_fit(sizes, [max(0, capacity - u) for u in used])
        if got is not None:
            return got
        capacity += step
        step *= 2


def _cells(groups: DataFrame, cell_groups: int):
    n = groups.count()
    return max(1, -(-n // cell_groups))


def sized_groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, size, text_crc32, gkey): the text itself goes no further."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), (utf8_bytes(text) + ROW_OVERHEAD).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                       F.coalesce(F.substring(F.sha2(text.cast("binary"), 256), 1, 32), F.lit("")).alias("gkey"))


def _pack_cell(n_cells: int, head: list[int]):
    """A cell's groups -> (gkey, piece, shard): its share of the head's bins is
    taken as used; the bins are turned by the cell so that rests spread."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "gkey", "piece"], ascending=[False, True, True])
        cell, bins = int(key[0]), len(head)
        turn = (cell * 7919) % bins
        used = [head[(k + turn) % bins] // n_cells for k in range(bins)]
        got = level_fit(pdf["bytes"].tolist(), used)
        return pd.DataFrame({"gkey": pdf["gkey"], "piece": pdf["piece"], "shard": [(b + turn) % bins for b in got]})
    return run


def pack(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
         head_groups: int = HEAD_GROUPS, cell_groups: int = CELL_GROUPS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot."""
    rows = written(sized_groups(docs, id_col, text_col))
    groups = written(rows.groupBy("gkey").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    mean = max(1, -(-total // n_shards))
    # fewer than n_shards groups exceed the mean, by arithmetic: their table is small
    large = F.broadcast(groups.filter(F.col("bytes") > mean).select(
        "gkey", F.ceil(F.col("bytes") * PIECES / F.lit(mean)).cast("int").alias("pieces")))
    rows = rows.join(large, "gkey", "left").select(
        "doc_id", "size", "text_crc32", "gkey",
        F.pmod(F.xxhash64("doc_id"), F.coalesce("pieces", F.lit(1))).cast("int").alias("piece"))
    whole = groups.join(large, "gkey", "left_anti").select("gkey", F.lit(0).alias("piece"), "bytes")
    parts = rows.join(large, "gkey", "left_semi").groupBy("gkey", "piece").agg(F.sum("size").alias("bytes"))
    units = written(whole.unionByName(parts))
    floor = max(1, -(-total // head_groups))
    head = units.filter(F.col("bytes") >= floor)  # at most head_groups units, by arithmetic
    tail = units.filter(F.col("bytes") < floor)
    schema = "gkey string, piece int, shard int"
    first = written(head.groupBy(F.lit(0).alias("cell")).applyInPandas(_pack_cell(1, [0] * n_shards), schema))
    used = dict(first.join(head, ["gkey", "piece"]).groupBy("shard").agg(F.sum("bytes")).collect())  # n_shards rows
    n_cells = _cells(tail, cell_groups)
    cell = F.pmod(F.xxhash64("gkey", "piece"), F.lit(n_cells)).cast("int").alias("cell")
    rest = tail.groupBy(cell).applyInPandas(_pack_cell(n_cells, [used.get(k, 0) for k in range(n_shards)]), schema)
    placed = rows.join(first.unionByName(rest), ["gkey", "piece"])
    return slots(placed.select("doc_id", "size", "text_crc32", "shard"))


def pack_capacity(docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text",
                  cell_groups: int = CELL_GROUPS, cell_bins: int = CELL_BINS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot, with as few shards of
    ``capacity`` bytes as best fit finds cell by cell."""
    rows = written(sized_groups(docs, id_col, text_col))
    groups = written(rows.groupBy("gkey").agg(F.sum("size").alias("bytes")))
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    n_cells = max(1, min(-(-count // cell_groups), total // (capacity * cell_bins)))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "gkey"], ascending=[False, True])
        return pd.DataFrame({"gkey": pdf["gkey"], "cell": int(key[0]),
                             "bin": best_fit(pdf["bytes"].tolist(), [], grow=capacity)})
    cell = F.pmod(F.xxhash64("gkey"), F.lit(n_cells)).cast("int").alias("cell")
    bins = written(groups.groupBy(cell).applyInPandas(run, "gkey string, cell int, bin int"))
    per_cell = bins.groupBy("cell").agg((F.max("bin") + 1).alias("bins"))
    before = per_cell.select("cell", (F.sum("bins").over(Window.orderBy("cell")) - F.col("bins")).alias("first"))
    placed = rows.join(bins, "gkey").join(before, "cell")
    return slots(placed.select("doc_id", "size", "text_crc32", (F.col("bin") + F.col("first")).cast("int").alias("shard")))


def slots(placed: DataFrame) -> DataFrame:
    """Gapless numbers from 0 in every shard: rows are numbered within (shard,
    lane) and offset by the shard's earlier lanes, so no task orders a shard."""
    n = lanes(placed.sparkSession)
    rows = written(placed.withColumn("lane", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n)).cast("int")))
    counts = rows.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    before = (Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("shard", "lane").orderBy("doc_id", "text_crc32")
    return (rows.withColumn("k", F.row_number().over(own)).join(first, ["shard", "lane"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("k") - 1).cast("long").alias("slot")))


def op7_sharding(spark, sf_dir) -> DataFrame:
    done = pack(table(spark, sf_dir, "documents", "doc_id", "text"), 40)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
