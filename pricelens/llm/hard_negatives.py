"""Hard negatives by Kronecker-packed products.

Vectors are quantised to integers, ``floor(scale * x)``, and scored by their
exact integer inner product.  Inside a tile of candidates and anchors several
candidates share one wide integer: with every candidate component c in
[-B, B] and every anchor component a in [-A, A], the biased component c + B is
put into a field of W bits, W being the least width that holds
d * 2A * 2B, and ``fields`` candidates are packed as sum (c_k + B) << (k W).
One multiplication by a + A then serves all of them; summed over the d
components, field k holds

    sum (a + A)(c_k + B) = <a, c_k> + A sum(c_k) + B sum(a) + d A B,

which never overflows into its neighbour, so subtracting three known sums
gives the exact score.  Words are 64-bit where a field fits into half of one,
otherwise Python's unbounded integers (numpy object arrays, same code).

Two passes over the same tiles: the first finds each anchor's positives (the
best rows of its own label), the second the best rows of other labels inside
each positive's score window.  Tiles come from a grid: candidates are dealt
to groups of about ``CANDIDATES`` rows and anchors to groups of about
``ANCHORS``; a candidate travels once per anchor group and an anchor once per
candidate group, so a tile's memory is fixed and the number of tiles grows
with the work.  Each tile returns at most the first ``positives`` (or
``negatives``) rows of an anchor, and Spark merges them by rank.  Nothing is
broadcast or collected.

Defined results.  Rows with a null label, a null vector, or a null or
non-finite component take no part, nor do rows without an id (nothing to
return).  Scores exist between vectors of one length only; empty vectors score
0 with each other.  Equal scores rank by the smaller id.  Rows that repeat an
id are rows of their own: each may be anchor, positive and negative.  Anchors
without positives or without fitting negatives return no row; so does an empty
table.  Components and scores outside the 64-bit range are held at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import table, written

CANDIDATES, ANCHORS = 8192, 4096
SLICE = 32  # anchors multiplied at a time: bounds a tile's score matrix
OBJECT_FIELDS = 16
LONG = (1 << 63) - 1


class Packed:
    """Integer candidates (rows x d) packed for anchors with components in
    [-a_max, a_max]."""

    def __init__(self, candidates: np.ndarray, a_max: int):
        self.n, self.d = candidates.shape
        self.a_max, self.c_max = a_max, largest(candidates)
        self.width = (max(1, self.d) * 2 * a_max * 2 * self.c_max).bit_length()
        self.small = self.width <= 32
        self.fields = 64 // self.width if self.small else OBJECT_FIELDS
        self.whole = np.int64 if self.small else object
        padded = np.zeros((-(-self.n // self.fields) * self.fields, self.d), self.whole)
        padded[:self.n] = candidates
        self.sums = padded.sum(axis=1) * a_max
        biased = self._wide(padded + self.c_max)
        words = np.zeros((len(padded) // self.fields, self.d), biased.dtype)
        for k in range(self.fields):  # rows k, k + fields, ... lie in field k
            words += biased[k::self.fields] << self._one(k * self.width)
        self.words = np.ascontiguousarray(words.T)

    def _wide(self, x: np.ndarray) -> np.ndarray:
        return x.astype(np.uint64) if self.small else x.astype(object)

    def _one(self, v: int):
        return np.uint64(v) if self.small else v

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors x candidates."""
        anchors = anchors.astype(self.whole)
        lifted = self._wide(anchors + self.a_max)
        acc = np.zeros((len(anchors), self.words.shape[1]), lifted.dtype)
        for j in range(self.d):  # one multiplication per anchor component and word
            acc += lifted[:, j, None] * self.words[j]
        mask = self._one((1 << self.width) - 1)
        out = np.empty((len(anchors), len(self.sums)), self.whole)
        for k in range(self.fields):
            out[:, k::self.fields] = ((acc >> self._one(k * self.width)) & mask).astype(self.whole)
        out -= self.sums
        out -= (anchors.sum(axis=1) * self.c_max + self.d * self.a_max * self.c_max)[:, None]
        return out[:, :self.n] if self.small else np.clip(out[:, :self.n], -LONG, LONG).astype(np.int64)


def largest(x: np.ndarray) -> int:
    """The greatest absolute value, 1 at least."""
    return max(1, int(x.max(initial=0)), -int(x.min(initial=0)))


def _vectors(t: pa.Table) -> np.ndarray:
    flat = t["q"].combine_chunks().flatten()
    return np.asarray(flat).astype(np.int64).reshape(len(t), t["dim"][0].as_py())


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first rows by (score descending, id ascending)."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _tile_positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"a_key": [], "vec_id": [], "score": []}
        if len(anchors) and len(rows):
            a, c = _vectors(anchors), _vectors(rows)
            ids, keys = rows["vec_id"].to_numpy(), rows["key"].to_numpy()
            labels, by_label = rows["label"].to_numpy(), {}
            for v in np.unique(labels):
                by_label[v] = np.flatnonzero(labels == v)
            a_keys, a_labels = anchors["key"].to_numpy(), anchors["label"].to_numpy()
            packed = Packed(c, largest(a))
            for at in range(0, len(a), SLICE):
                for x, s in enumerate(packed.scores(a[at:at + SLICE]), at):
                    same = by_label.get(a_labels[x])
                    if same is None:
                        continue
                    same = same[keys[same] != a_keys[x]]
                    best = same[_first(s[same], ids[same], k)]
                    out["a_key"] += [a_keys[x]] * len(best)
                    out["vec_id"] += ids[best].tolist()
                    out["score"] += s[best].tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})
    return run


def _tile_negatives(k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {n: [] for n in ("a_key", "p_rank", "vec_id", "score")}
        if len(anchors) and len(rows):
            a, c = _vectors(anchors), _vectors(rows)
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            a_keys, a_labels = anchors["key"].to_numpy(), anchors["label"].to_numpy()
            wanted = anchors["positives"].to_pylist()
            packed = Packed(c, largest(a))
            for at in range(0, len(a), SLICE):
                for x, s in enumerate(packed.scores(a[at:at + SLICE]), at):
                    other = np.flatnonzero((labels != a_labels[x]) & (s <= max(p["score"] for p in wanted[x])))
                    near = s[other]
                    for p in wanted[x]:
                        # low P <= 100 N <= high P on integers: ceiling and floor of the bounds
                        fits = other[(near >= -(-low * p["score"] // 100)) & (near <= high * p["score"] // 100)]
                        best = fits[_first(s[fits], ids[fits], k)]
                        out["a_key"] += [a_keys[x]] * len(best)
                        out["p_rank"] += [p["rank"]] * len(best)
                        out["vec_id"] += ids[best].tolist()
                        out["score"] += s[best].tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})
    return run


def quantised(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding",
              label: Column | None = None) -> DataFrame:
    """(key, vec_id, label, dim, q): the rows that take part, written once so
    that ``key`` stays the same for both passes."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          (F.col("label") if label is None else label).cast("long").alias("label"),
                          v.cast("array<double>").alias("v"))
    whole = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & whole)
    return written(rows.select(F.monotonically_increasing_id().alias("key"), "vec_id", "label",
                               F.size("v").alias("dim"),
                               F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("q")))


def _copies(rows: DataFrame, group: str, key: Column, groups: int, others: int, other: str) -> DataFrame:
    """Rows dealt to ``groups`` by ``key``, one copy for each of the ``others``."""
    return (rows.withColumn(group, F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, candidates_per_tile: int = CANDIDATES,
                   anchors_per_tile: int = ANCHORS) -> DataFrame:
    """``rows`` as from ``quantised``.  Per anchor, its first ``positives``
    rows of the same label; per such positive of score P, the first
    ``negatives`` rows of other labels with low * P <= 100 * N <= high * P."""
    picked = rows.filter(is_anchor)
    n, m = rows.count(), picked.count()
    c_groups, a_groups = max(1, -(-n // candidates_per_tile)), max(1, -(-m // anchors_per_tile))
    grid = ["dim", "a_group", "c_group"]
    cand = _copies(rows, "c_group", F.col("key"), c_groups, a_groups, "a_group")
    cand = cand.select(*grid, "key", "vec_id", "label", "q").toDF(*grid, "key", "vec_id", "label", "q")

    def tiles(anchors: DataFrame, work, schema: str) -> DataFrame:
        a = _copies(anchors, "a_group", F.col("key"), a_groups, c_groups, "c_group")
        a = a.toDF(*a.columns)  # fresh columns: both sides come from the same rows
        return a.groupBy(*grid).cogroup(cand.groupBy(*grid)).applyInArrow(work, schema)

    def firsts(df: DataFrame, keys: list[str], k: int) -> DataFrame:
        by = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
        return df.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)

    best = firsts(tiles(picked.select("dim", "key", "label", "q"), _tile_positives(positives),
                        "a_key long, vec_id long, score long"), ["a_key"], positives)
    best = written(best.groupBy(F.col("a_key").alias("key")).agg(  # at most ``positives`` a key
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives")))
    wanted = picked.join(best, "key")
    found = firsts(tiles(wanted.select("dim", "key", "label", "q", "positives"),
                         _tile_negatives(negatives, low, high),
                         "a_key long, p_rank long, vec_id long, score long"), ["a_key", "p_rank"], negatives)
    pos = wanted.select(F.col("key").alias("a_key"), F.col("vec_id").alias("anchor_id"), F.inline("positives"))
    pos = pos.select("a_key", "anchor_id", F.col("rank").cast("long").alias("p_rank"),
                     F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (found.select("a_key", "p_rank", F.col("rank").cast("int").alias("rank"),
                         F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pos, ["a_key", "p_rank"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_hard_negatives(spark, sf_dir) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = quantised(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), 256,
                     label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(rows, vec_id % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.q) = len(c.q)),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
