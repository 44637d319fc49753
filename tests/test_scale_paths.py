"""Bounded sides, partition-scoped merges and other paths that matter at scale."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from pricelens.session import checkpoint_dir
from pricelens.sources import tables as tb



def test_checkpoint_dir_reads_the_session_setting(spark):
    path = checkpoint_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == path
    assert checkpoint_dir(spark) == path  # set once, then read


def test_merge_rewrites_only_touched_partitions(spark):
    tb.ensure_namespaces(spark)
    name = "bronze.merge_scope"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = "k string, v string, _ingested_at timestamp, period string"
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    first = spark.createDataFrame([("a", "1", t0, "p1"), ("b", "1", t0, "p2"), ("c", "1", t0, "p3")], cols)
    tb.merge_partitions(first, name, ["k", "period"], "period")
    root = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type
    root = root.replace("file:", "")
    before = {p: sorted(glob.glob(os.path.join(root, f"period={p}", "*.parquet"))) for p in ("p1", "p2", "p3")}
    upd = spark.createDataFrame([("b", "2", t1, "p2"), ("d", "1", t1, "p2")], cols)
    tb.merge_partitions(upd, name, ["k", "period"], "period")
    after = {p: sorted(glob.glob(os.path.join(root, f"period={p}", "*.parquet"))) for p in ("p1", "p2", "p3")}
    assert after["p1"] == before["p1"] and after["p3"] == before["p3"]
    assert after["p2"] != before["p2"]
    got = sorted((r.k, r.v, r.period) for r in spark.table(name).collect())
    assert got == [("a", "1", "p1"), ("b", "2", "p2"), ("c", "1", "p3"), ("d", "1", "p2")]
