"""Helpers shared by the operators: tables, written intermediates, components."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one input table (only those are scanned)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and
    read back: later stages read files that every executor sees, so a lost
    executor costs no recomputation.  The folder goes when the application
    ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value):
    """``value`` broadcast as bytes; call the result in a task to get it back.
    Classes of this package travel by value inside the bytes, so executors
    need no installed copy of it.  Only for values of bounded size."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        import pickle
        return pickle.loads(held.value)
    return get


def lanes(spark: SparkSession, per_partition: int = 1) -> int:
    """A number of salts that follows the session's shuffle partitions."""
    return max(1, per_partition * int(spark.conf.get("spark.sql.shuffle.partitions")))


def row_slices(texts, most: int):
    """(start, length) of runs of rows of about ``most`` bytes."""
    import numpy as np
    import pyarrow.compute as pc
    total = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    start = 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, "right")))
        yield start, end - start
        start = end


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return crc % modulus == F.lit(remainder)


def min_label_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as rows
    (node, component_id = smallest reachable node), nodes with an edge only.

    Alternates large-star and small-star rounds: every round is two grouped
    aggregations over the edges and never gathers a component in one task
    beyond the edges of one node; each round is written to the shared folder,
    and the loop ends when the edge set no longer changes.  Self links and
    null ends are dropped.
    """
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    e = e.filter("a is not null and b is not null and a <> b")
    e = written(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u is linked to the least of u's neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        # small star: u and its smaller neighbours are linked to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m").alias("y")),
                                           F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("s"))
                 .select(F.col("s.x").alias("a"), F.col("s.y").alias("b")).filter("a <> b").distinct())
        e = written(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == tuple(before):
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.groupBy("a").agg(F.min("b").alias("component_id"))
            .select(F.col("a").alias("node"), "component_id")
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()))
