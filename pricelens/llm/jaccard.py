"""Exact n-gram Jaccard self-join by partitioning the shingle universe.

Sets with Jaccard similarity t or more differ in at most
(1 - t) / (1 + t) * (|x| + |y|) shingles.  Sizes fall into bands; in the scheme
of a band the hash space is cut into ``m`` segments, and a set's signature in a
segment is the hash of the shingles that fall there.  If two sets differ in at
most H shingles, then among segments whose allowances (0: equal, 1: at most one
deletion) plus one add up to more than H, one segment keeps its allowance
(pigeonhole).  ``plan_band`` picks m and the number r of segments that also
index their one-deletion neighbourhoods, by cost (rows to write, and segments so
small that unrelated sets share them), with some segments to spare.

* Equal sets are folded first (128-bit digest of the set): one representative.
* A set indexes all segments of its own band and of the bands whose smaller sets
  it can match, and probes in its own band only.
* Cost-based allocation: group sizes of all signatures are counted, and each set
  leaves out its most frequent segments, as many as its own H can spare.
* In a signature's group, members are paired with one probing hub, not with each
  other, and a member first with the hub it shares most signatures with.  The
  hub is the member that meets the most others over all its signatures.  After
  verification the members that the hub did not take into its
  component are paired with the members of other components in the group, so no
  link between different components is lost and no group emits all its pairs.
* Pairs are cut by size and by an odd sketch (a bit for each hash bucket, set
  where it holds an odd number of shingles: two sets differ in at least as many
  shingles as bits), then verified exactly on the whole shingle sets.

Sets are compared as 64-bit shingle hashes: two different shingles of one pair
share a hash once in about 2**63 / size**2 pairs.  A set is numbered by 64 bits of
its digest, so that copies signed in different tasks fold where their signatures
meet: of n different sets, about n**2 / 2**65 pairs share a number and may be
taken for each other.  A document whose text stands for its set is found by its
id, or, where an id has several texts, by 64 bits of (id, text digest).  Null and
empty texts and texts
without words have no shingles and link with nothing.  Rows with a null id have
no component and do not take part in links.  Rows that repeat an id are linked
each by its own text; equal sets are one node whatever their ids.  An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import min_label_components, table, written
from pricelens.llm.shingles import mix, shingle_set

SPARE = 0.1
SMALL_SEGMENT_COST = 5.0
SEEN = 500_000
BAND_RATIO = 1.5
SKETCH_WORDS = 16  # 64 bits each


def most_different(size: int, t: Fraction) -> int:
    """Largest difference of a linked pair whose smaller set has ``size``."""
    return int(size * (1 / t - 1))


def plan_band(low: int, high: int, t: Fraction) -> tuple[int, int]:
    """(m segments, r of them with one-deletion neighbourhoods) for pairs whose
    smaller set has low..high shingles: m + r >= H + 1 + spare, least cost."""
    need = most_different(high, t) + 1
    need += max(1, math.ceil(SPARE * need))

    def cost(m: int) -> float:
        return m + (need - m) * high / m + SMALL_SEGMENT_COST * m * 2.0 ** (-low / m)
    m = min(range(-(-need // 2), need + 1), key=lambda m: (cost(m), m))
    return m, need - m


def bands(largest: int, t: Fraction) -> list[tuple[int, int]]:
    """Size bands (low, high), from the least size at which unequal sets link."""
    out, low = [], 1
    while most_different(low, t) < 1:
        low += 1
    while low <= largest:
        high = max(low, int(low * BAND_RATIO))
        out.append((low, high))
        low = high + 1
    return out


def schemes(size: int, t: Fraction) -> list[tuple[int, int, int, int, bool]]:
    """(band, m, r, spare, own) in which a set of ``size`` writes signatures."""
    out = []
    for k, (low, high) in enumerate(bands(size, t)):
        own = low <= size <= high
        if own or (size > high and high >= t * size):
            m, r = plan_band(low, high, t)
            out.append((k, m, r, m + r - most_different(size, t) - 1 if own else 0, own))
    return out


def signatures(h: np.ndarray, plans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, segment weight, spare; spare < 0 where the set only indexes)
    of one shingle set."""
    sig, weight, spare = [], [], []
    with np.errstate(over="ignore"):
        inner = mix(h + np.uint64(0x9E3779B97F4A7C15))
        for band, m, r, extra, own in plans:
            seg = ((h >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)  # h sorted: seg ascending
            sums = np.zeros(m, np.uint64)
            found, at = np.unique(seg, return_index=True)
            sums[found] = np.add.reduceat(inner, at)
            salt = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32) + np.uint64(1))
            sig.append(mix(sums + salt))
            weight.append(np.where(np.arange(m) < r, 2, 1))
            cut = np.flatnonzero(seg < r)
            if len(cut):  # one-deletion neighbourhoods of the first r segments
                sig.append(mix(sums[seg[cut]] - inner[cut] + salt[seg[cut]]))
                weight.append(np.zeros(len(cut), np.int64))
            spare.append(np.full(m + len(cut), extra if own else -1))
    if not sig:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(sig).view(np.int64), np.concatenate(weight), np.concatenate(spare)


def _sign(words: int, t: Fraction):
    """(doc_id, text) -> doc_id, size, digest, odd sketch, signatures."""
    def run(batches):
        plans: dict[int, list] = {}
        seen: set[bytes] = set()
        for batch in batches:
            cols = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                h = shingle_set(text.as_py(), words)
                with np.errstate(over="ignore"):
                    digest = _digest(h)
                    bucket = (mix(h) >> np.uint64(32)) * np.uint64(64 * SKETCH_WORDS) >> np.uint64(32)
                    odd = np.packbits(np.bincount(bucket.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1).view(np.int64)
                if len(h) not in plans:
                    plans[len(h)] = schemes(len(h), t)
                signed = None
                if len(h) and doc_id.is_valid and digest not in seen:  # a task signs one copy of a set
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(digest)
                    sig, weight, spare = signatures(h, plans[len(h)])
                    signed = (sig, np.where(spare < 0, -1, 3 * spare + weight).astype(np.int32))
                whole = hashlib.md5((text.as_py() or "").encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                for c, v in zip(cols, (whole, len(h), digest, odd, *(signed or (None, None))), strict=True):
                    c.append(v)
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                ["doc_id", "text_md5", "size", "digest", "odd", "sig", "role"])
    return run


def _digest(h: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        return (int(h.sum(dtype=np.uint64)).to_bytes(8, "little")
                + int(mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)).to_bytes(8, "little"))


def _sets(words: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(x.as_py(), words) for x in batch.column(1)]
            cols = [[len(h) for h in sets], [_digest(h) for h in sets], [h.view(np.int64) for h in sets]]
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["size", "digest", "shingles"])
    return run


def _set_number() -> Column:
    return F.xxhash64("size", "digest")


def _numbered(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_md5, ...) with ``row``, the number of the document:
    its id, or 64 bits of (id, text digest) where ``repeated`` lists the id."""
    several = repeated.select(F.col("doc_id").alias("several"))
    return (rows.join(several, F.col("doc_id") == F.col("several"), "left")
            .withColumn("row", F.when(F.col("several").isNull(), F.col("doc_id"))
                        .otherwise(F.xxhash64("doc_id", "text_md5"))).drop("several"))


def _may_link(t: Fraction) -> Column:
    """Bounds that every linked pair keeps: sizes, and the bits in which the odd
    sketches differ, each the work of a differing shingle."""
    up, down = t.numerator, t.denominator
    apart = sum((F.bit_count(F.col("oa")[k].bitwiseXOR(F.col("ob")[k])) for k in range(SKETCH_WORDS)), F.lit(0))
    return ((F.least("na", "nb") * down >= F.greatest("na", "nb") * up)
            & (apart * (up + down) <= (F.col("na") + F.col("nb")) * (down - up)))


def _verified(pairs: DataFrame, reps: DataFrame, src: DataFrame, repeated: DataFrame, words: int,
              t: Fraction) -> DataFrame:
    """The candidate pairs (a, b) that link, on whole shingle sets."""
    up, down = t.numerator, t.denominator
    info = reps.select("rep", "size", "odd")
    near = (pairs.join(info.select(F.col("rep").alias("a"), F.col("size").alias("na"), F.col("odd").alias("oa")), "a")
            .join(info.select(F.col("rep").alias("b"), F.col("size").alias("nb"), F.col("odd").alias("ob")), "b"))
    near = written(near.filter(_may_link(t)).select("a", "b", "na", "nb"))
    ids = written(near.select(F.col("a").alias("rep")).union(near.select("b")).distinct())
    texts = _numbered(src.withColumn("text_md5", F.unhex(F.md5(F.col("text").cast("binary")))), repeated)
    carriers = written(reps.join(ids, "rep", "left_semi").select("row"))
    sets = (texts.join(carriers, "row", "left_semi").select("row", "text")
            .mapInArrow(_sets(words), "size long, digest binary, shingles array<long>")
            .select(_set_number().alias("rep"), "shingles").dropDuplicates(["rep"]))  # both joins read this one shuffle
    both = (near.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(common * (up + down) >= (F.col("na") + F.col("nb")) * up).select("a", "b")


def jaccard_components(docs: DataFrame, words: int = 5, threshold: str = "0.8", id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by
    links), representative (smallest id with the same shingle set), text_md5
    (of the whole text), group (a number that the rows of one component share,
    and no others; null for rows that cannot link).  Rows of one id with
    different texts are different rows, each linked by its own text."""
    t = Fraction(threshold)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = written(src.mapInArrow(_sign(words, t), "doc_id long, text_md5 binary, size long, digest binary, "
                                    "odd array<long>, sig array<long>, role array<int>"))
    # ids with several texts
    repeated = written(signed.filter("size > 0 and doc_id is not null").groupBy("doc_id")
                       .agg(F.min("text_md5").alias("lo"), F.max("text_md5").alias("hi"))
                       .filter("lo <> hi").select("doc_id"))
    per_set = signed.filter("size > 0 and doc_id is not null")
    # row: one document that holds the set; least: its smallest id of all
    reps = written(_numbered(per_set.drop("sig", "role"), repeated).groupBy("size", "digest").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("least"), F.first("odd").alias("odd"))
        .withColumn("rep", _set_number()))
    rows = (per_set.filter("sig is not null")
            .select(_set_number().alias("rep"), F.explode(F.arrays_zip("sig", "role")).alias("s"))
            .select("rep", "s.sig", "s.role"))
    group = Window.partitionBy("sig")
    # signatures that different sets share; copies of one set from several tasks fold in place
    met = rows.withColumns({"lo": F.min("rep").over(group), "hi": F.max("rep").over(group)}).filter("lo <> hi")
    shared = written(met.select("rep", "sig", "role").distinct().withColumn("n", F.count("*").over(group)))
    # allocation: leave out the most frequent segments that the set can spare
    costly = (Window.partitionBy("rep").orderBy(F.col("n").desc(), "sig")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spare, weight = F.floor(F.col("role") / 3), F.col("role") % 3
    # a set that meets many others is the likelier middle of its near copies
    probing = shared.filter("role >= 0").withColumns({"spent": F.sum(weight).over(costly),
                                                      "met": F.sum("n").over(Window.partitionBy("rep"))})
    rows = (probing.select("rep", "sig", ((F.col("spent") > spare) | (weight == 0)).alias("probe"), "met")
            .unionByName(shared.filter("role < 0").select("rep", "sig", F.lit(False).alias("probe"),
                                                          F.lit(0).cast("long").alias("met"))))
    order = (group.orderBy(F.col("probe").desc(), F.col("met").desc(), "rep")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    star = written(rows.withColumns({"hub": F.first("rep").over(order), "asked": F.first("probe").over(order)})
                   .filter("asked").select("sig", "hub", "rep", "probe"))
    pair = [F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")]
    # first the hub with which a member shares most signatures: one pair for each member
    shares = star.filter("hub <> rep").groupBy("rep", "hub").agg(F.count("*").alias("k"))
    best = shares.groupBy("rep").agg(F.max(F.struct("k", (-F.col("hub")).alias("h"))).alias("m"))
    tested = written(best.select((-F.col("m.h")).alias("hub"), "rep").select(*pair).distinct())
    links = written(_verified(tested, reps, src, repeated, words, t))
    part = written(min_label_components(links))
    # members that their hub's component did not take in
    label = star.join(part.select(F.col("node").alias("rep"), F.col("component_id").alias("c")), "rep", "left")
    label = label.join(part.select(F.col("node").alias("hub"), F.col("component_id").alias("h")), "hub", "left")
    label = label.select("sig", "rep", "probe", F.coalesce("c", "rep").alias("c"), F.coalesce("h", "hub").alias("h"))
    outside = written(label.filter("c <> h"))
    info = reps.select("rep", "size", "odd")
    ours = outside.join(info, "rep").select("sig", F.col("rep").alias("x"), F.col("probe").alias("px"),
                                            F.col("c").alias("cx"), F.col("size").alias("na"), F.col("odd").alias("oa"))
    rest = (label.join(outside.select("sig").distinct(), "sig", "left_semi").join(info, "rep")
            .select("sig", F.col("rep").alias("y"), F.col("probe").alias("py"), F.col("c").alias("cy"),
                    F.col("size").alias("nb"), F.col("odd").alias("ob")))
    # the bounds are part of the join, so that sets which merely share a segment never become a row
    more = (ours.join(rest.withColumnRenamed("sig", "s"), (F.col("sig") == F.col("s")) & (F.col("cx") != F.col("cy"))
                      & (F.col("px") | F.col("py")) & _may_link(t))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
            .join(tested, ["a", "b"], "left_anti"))
    found = written(_verified(more, reps, src, repeated, words, t))
    graph = links.unionByName(found)
    whole = min_label_components(graph).withColumnRenamed("node", "rep")
    named = written(reps.join(whole, "rep", "left").select("size", "digest", "rep", "least",
                                                           F.coalesce("component_id", "rep").alias("c")))
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    named = named.join(least, "c").select("size", "digest", "least", "component_id", "c")
    out = signed.select("doc_id", "text_md5", "size", "digest").join(named, ["size", "digest"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    return out.select("doc_id", F.col("size").alias("n_shingles"),
                      F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.when(linked, F.col("least")).otherwise(F.col("doc_id")).alias("representative"),
                      "text_md5", F.when(linked, F.col("c")).alias("group"))


def op3_jaccard(spark, sf_dir) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"), 4, "0.85").select(
        "doc_id", "n_shingles", "component_id")
