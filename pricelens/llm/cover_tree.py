"""Exact cosine near-duplicates by dual traversal of cover trees.

On unit vectors cosine >= c is Euclidean distance <= sqrt(2 - 2c).  The tree's
top level is a set of pivots, a net taken from a bounded sample (``MAX_PIVOTS``);
every vector goes to its nearest pivot, whose covering radius is measured over
all its vectors.  Pivot pairs too far apart for any link are pruned.  A pivot
with more than ``CHUNK`` vectors is dealt over chunks by a hash, so a hot group
is spread and no task holds more than two chunks.

Each chunk builds its lower levels once: nested nets with halving radii, every
level's centres among the members of the level above, radii measured.  A task
takes a pair of chunks and walks both trees together: a node pair farther apart
than its radii allow is dropped, one wholly within the threshold counts all its
pairs without listing them, the rest opens its larger node.  Vectors that meet
at the bottom are compared exactly in double precision.

A task returns, for every vector, how many links it found, and a spanning forest
of the links: as many rows as vectors, never the pairs.  Components follow from
the forests.

A vector that is null, zero or with null or non-finite parts links with nothing
and is kept as its own class; vectors of different lengths do not link.  Every
row is a vector of its own, also where an id repeats or is null; the class is
the smallest id of its rows (null where none has an id).  Equal vectors link.
An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import min_label_components, table, written

CHUNK = 4096
MAX_PIVOTS = 256
SAMPLE = 4096
TOP = 0.5
LEVELS = 3
EDGE = 1e-9  # distances this near a bound are settled exactly


def net(x: np.ndarray, radius: float) -> np.ndarray:
    """Index of each row's centre; centres lie more than ``radius`` apart and
    cover their rows.  Rows are taken in blocks, first come first centre."""
    centre = np.full(len(x), -1)
    chosen: list[int] = []
    reach = 1 - radius * radius / 2
    for a in range(0, len(x), 512):
        rows = np.arange(a, min(len(x), a + 512))
        if chosen:
            cos = x[rows] @ x[chosen].T
            best = cos.argmax(1)
            near = cos[np.arange(len(rows)), best] >= reach
            centre[rows[near]] = np.array(chosen)[best[near]]
            rows = rows[~near]
        if len(rows):
            cos = x[rows] @ x[rows].T
            open_ = np.ones(len(rows), bool)
            for k in range(len(rows)):
                if open_[k]:
                    chosen.append(int(rows[k]))
                    own = open_ & (cos[k] >= reach)
                    own[k] = True
                    centre[rows[own]] = rows[k]
                    open_ &= ~own
    return centre


def build(x: np.ndarray) -> np.ndarray:
    """(rows, LEVELS) centre of each row at radii TOP, TOP / 2, ...: nested."""
    out = np.empty((len(x), LEVELS), np.int32)
    groups = [np.arange(len(x))]
    for level in range(LEVELS):
        deeper = []
        for g in groups:
            c = net(x[g], TOP / 2 ** level) if len(g) > 1 else np.zeros(1, int)
            out[g, level] = g[c]
            if level + 1 < LEVELS:
                deeper += [g[c == k] for k in np.unique(c)]
        groups = deeper
    return out


class Tree:
    """Nodes of a chunk in depth-first ranges of ``order``: start, end, centre
    row, radius, children."""

    def __init__(self, x: np.ndarray, path: np.ndarray):
        self.x = x
        self.order = np.lexsort(tuple(path[:, k] for k in reversed(range(LEVELS))))
        p = path[self.order]
        self.levels = []
        new = np.zeros(len(x), bool)
        new[:1] = True
        for k in range(LEVELS):
            new = new | np.concatenate((np.ones(min(1, len(x)), bool), p[1:, k] != p[:-1, k]))
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(x))
            centre = p[start, k]
            of = np.repeat(np.arange(len(start)), end - start)
            apart = np.linalg.norm(x[self.order] - x[centre][of], axis=1)
            radius = np.maximum.reduceat(apart, start) if len(start) else np.zeros(0)
            self.levels.append((start, end, centre, radius))


def dual(ta: Tree, tb: Tree, same: bool, cosine: float):
    """(links per row of a, links per row of b, forest edges (row a, row b)).
    For ``same`` trees each unordered pair is looked at once."""
    limit = math.sqrt(max(0.0, 2 - 2 * cosine))
    na, nb = np.zeros(len(ta.x), np.int64), np.zeros(len(tb.x), np.int64)
    parent = np.arange(len(ta.x) + (0 if same else len(tb.x)))
    shift = 0 if same else len(ta.x)
    edges: list[tuple[int, int]] = []

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def join(i, j):
        a, b = find(i), find(j + shift)
        if a != b:
            parent[max(a, b)] = min(a, b)
            edges.append((int(i), int(j)))

    def all_linked(i, j):
        """Every row of i links with every row of j."""
        if same and i is j:
            na[i] += len(i) - 1
            for r in i[1:]:
                join(i[0], r)
            return
        na[i] += len(j)
        nb_ = na if same else nb
        nb_[j] += len(i)
        for r in j:
            join(i[0], r)
        for r in i[1:]:
            join(r, j[0])

    def exact(i, j):
        cos = ta.x[i] @ tb.x[j].T
        hit = cos >= cosine
        if same and i is j:
            hit &= ~np.eye(len(i), dtype=bool)
            na[i] += hit.sum(1)
        else:
            na[i] += hit.sum(1)
            (na if same else nb)[j] += hit.sum(0)
        r, c = np.nonzero(hit)
        for p, q in zip(i[r], j[c], strict=True):
            join(p, q)

    sa, ea, ca, ra = ta.levels[0]
    sb, eb, cb, rb = tb.levels[0]
    pairs = []
    for lo in range(0, len(ca), 1024):  # top level: all node pairs, in blocks
        cos = ta.x[ca[lo:lo + 1024]] @ tb.x[cb].T
        d = np.sqrt(np.maximum(0, 2 - 2 * cos))
        i, j = np.nonzero(d <= limit + ra[lo:lo + 1024, None] + rb[None, :] + EDGE)
        pairs.append(np.stack((i + lo, j), 1))
    front = np.concatenate(pairs) if pairs else np.zeros((0, 2), int)
    if same:
        front = front[front[:, 0] <= front[:, 1]]
    for level in range(LEVELS):
        sa, ea, ca, ra = ta.levels[level]
        sb, eb, cb, rb = tb.levels[level]
        a, b = front[:, 0], front[:, 1]
        d = np.linalg.norm(ta.x[ca[a]] - tb.x[cb[b]], axis=1)
        keep = d <= limit + ra[a] + rb[b] + EDGE
        inside = keep & (d + ra[a] + rb[b] <= limit - EDGE)
        if same:  # a node with itself: its diameter bounds its pairs
            inside &= (a != b) | (2 * ra[a] <= limit - EDGE)
        rows_a = [ta.order[sa[k]:ea[k]] for k in a[inside]]
        for i, p, q in zip(rows_a, a[inside], b[inside], strict=True):
            all_linked(i, i if same and p == q else tb.order[sb[q]:eb[q]])
        front = front[keep & ~inside]
        if level + 1 == LEVELS:
            for p, q in front:
                i = ta.order[sa[p]:ea[p]]
                exact(i, i if same and p == q else tb.order[sb[q]:eb[q]])
            break
        below_a, below_b = ta.levels[level + 1][0], tb.levels[level + 1][0]
        out = []
        for p, q in front:
            i = np.arange(np.searchsorted(below_a, sa[p]), np.searchsorted(below_a, ea[p]))
            j = np.arange(np.searchsorted(below_b, sb[q]), np.searchsorted(below_b, eb[q]))
            got = np.stack(np.meshgrid(i, j, indexing="ij"), -1).reshape(-1, 2)
            out.append(got[got[:, 0] <= got[:, 1]] if same and p == q else got)
        front = np.concatenate(out) if out else np.zeros((0, 2), int)
    return na, nb, edges


def _matrix(values) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in values])


def _assign(pivots):
    def run(frames):
        p = pivots.value
        for f in frames:
            if len(f):
                x = _matrix(f["v"])
                cos = x @ p.T
                at = cos.argmax(1)
                f["pivot"] = at
                f["apart"] = np.linalg.norm(x - p[at], axis=1)
            else:
                f["pivot"], f["apart"] = [], []
            yield f[["vec_id", "v", "pivot", "apart"]]
    return run


def _tree_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id").reset_index(drop=True)
    return pd.DataFrame({"chunk": pdf["chunk"], "vec_id": pdf["vec_id"], "v": pdf["v"],
                         "path": list(build(_matrix(pdf["v"])))})


def _walk(cosine: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = int(key[0]), int(key[1])
        pdf = pdf.sort_values("vec_id").reset_index(drop=True)
        sides = [pdf[pdf["chunk"] == k].reset_index(drop=True) for k in dict.fromkeys((p, q))]
        trees = [Tree(_matrix(s["v"]), np.stack(s["path"].to_list())) for s in sides]
        na, nb, edges = dual(trees[0], trees[-1], p == q, cosine)
        ids = [s["vec_id"].to_numpy() for s in sides]
        out = [pd.DataFrame({"a": ids[0], "b": pd.NA, "n": na})]
        if p != q:
            out.append(pd.DataFrame({"a": ids[1], "b": pd.NA, "n": nb}))
        out = [o[o["n"] > 0] for o in out]
        out.append(pd.DataFrame({"a": [ids[0][i] for i, _ in edges], "b": [ids[-1][j] for _, j in edges], "n": 0}))
        return pd.concat(out).astype({"a": "Int64", "b": "Int64", "n": "Int64"})
    return run


def near_duplicates(vectors: DataFrame, cosine: float, id_col: str = "vec_id", vector_col: str = "embedding",
                    chunk: int = CHUNK, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.  Only vectors of one
    length meet; each length is joined for itself."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.monotonically_increasing_id().alias("key"))
    rows = written(rows)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    scaled = F.transform("v", lambda x: x / largest)  # lengths neither overflow nor vanish
    good = rows.filter(F.col("v").isNotNull() & finite & (largest > 0)).select("key", scaled.alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = written(good.select(F.col("key").alias("vec_id"), F.transform("v", lambda x: x / length).alias("v")))
    sizes = unit.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()  # one row a length
    found = None
    for r in sizes:
        own = _links(unit.filter(F.size("v") == r["d"]), r["n"], cosine, chunk, max_pivots)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "a long, b long, n long")
    links = found.filter("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    parts_of = min_label_components(found.filter("b is not null").select("a", "b"))
    named = rows.select("key", "vec_id").join(parts_of.select(F.col("node").alias("key"), F.col("component_id").alias("c")),
                                              "key", "left").join(links, "key", "left")
    named = written(named.withColumn("c", F.coalesce("c", "key")))
    least = named.groupBy("c").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "c").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("component_id").eqNullSafe(F.col("vec_id")).alias("kept"))


def _links(unit: DataFrame, n: int, cosine: float, chunk: int, max_pivots: int) -> DataFrame:
    """(a, null, n): links of a vector; (a, b, 0): edges that hold its
    component together, of ``n`` unit vectors (vec_id, v) of one length."""
    spark = unit.sparkSession
    sample = _matrix(r["v"] for r in unit.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect())
    wanted, radius = min(max_pivots, -(-n // chunk)), 2.0
    centres = np.unique(net(sample, radius))
    while len(centres) < wanted and radius > 0.1:  # halve until enough centres cover the sample
        radius /= 2
        centres = np.unique(net(sample, radius))
    pivots = sample[centres[:wanted]]
    placed = written(unit.mapInPandas(_assign(spark.sparkContext.broadcast(pivots)),
                                      "vec_id long, v array<double>, pivot int, apart double"))
    stats = {r["pivot"]: r for r in placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("apart").alias("r"))
             .collect()}  # at most max_pivots rows
    limit, parts, first = math.sqrt(2 - 2 * cosine), {}, {}
    for k in sorted(stats):
        parts[k], first[k] = max(1, math.ceil(stats[k]["n"] / chunk)), sum(parts.values())
    pairs = []
    for i, a in enumerate(sorted(stats)):
        for b in sorted(stats)[i:]:
            if a == b or np.linalg.norm(pivots[a] - pivots[b]) <= limit + stats[a]["r"] + stats[b]["r"] + EDGE:
                pairs.append((a, b))
    plan = spark.createDataFrame([(k, parts[k], first[k]) for k in parts], "pivot int, parts int, first int")
    near = spark.createDataFrame(pairs, "x int, y int")
    rangeof = F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)
    chunks = plan.select("pivot", F.explode(rangeof).alias("chunk"))
    tasks = (near.join(chunks.select(F.col("pivot").alias("x"), F.col("chunk").alias("p")), "x")
             .join(chunks.select(F.col("pivot").alias("y"), F.col("chunk").alias("q")), "y")
             .filter("x < y or p <= q").select("p", "q"))
    sides = tasks.select(F.explode(F.array_distinct(F.array("p", "q"))).alias("chunk"), "p", "q")
    chunked = placed.join(F.broadcast(plan), "pivot").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("chunk"), "vec_id", "v")
    trees = written(chunked.groupBy("chunk").applyInPandas(
        _tree_rows, "chunk int, vec_id long, v array<double>, path array<int>"))
    return written(trees.join(sides, "chunk").groupBy("p", "q").applyInPandas(_walk(cosine), "a long, b long, n long"))


def op4_cover_tree(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), 0.95)
