"""Blocked windows equal plain ones; incremental layers equal a full rebuild."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.operators import series as sr
from pricelens.operators.blocks import BLOCK, blocked, day_block, reached_blocks
from pricelens.operators.silver import silver_prices
from pricelens.plans.incremental import IncrementalLayers
from pricelens.sources import adapter, pages

from conftest import SF_SMALL
from helpers import silver_df, silver_rows


def gappy(spark, seed):
    """Three series with gaps from days to years."""
    r, rows = random.Random(seed), []
    for key, n in (("a", 60), ("b", 25), (None, 9)):
        day = 10_000
        for _ in range(n):
            day += r.choice([1, 7, 7, 7, 40, 700])
            rows.append((key, day, float(r.randint(1, 99))))
    return spark.createDataFrame(rows, "k string, d int, v double").withColumn("d", F.date_from_unix_date("d"))


@pytest.mark.parametrize("days", [1, 30, 5000])
@pytest.mark.parametrize("lookback", [1, 5, 11])
def test_any_gap_and_block_size(spark, days, lookback):
    df = gappy(spark, lookback)

    def cols(w):
        return {"prev": F.lag("v", lookback).over(w), "sum": F.sum("v").over(w.rowsBetween(-lookback, 0))}
    plain = df.withColumns(cols(Window.partitionBy("k").orderBy("d")))
    got = blocked(df, ["k"], "d", lookback, day_block("d", days), cols)
    assert sorted(map(repr, got.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_weekly_blocked_and_its_parallelism(spark):
    silver = silver_df(spark, silver_rows("EPMR", [1 + (k * 37 % 50) / 10 for k in range(200)], skip=set(range(40, 90)))
                       + silver_rows("EPMP", [2.0, 3.0]))
    want = sr.weekly_summary(silver)
    got = sr.weekly_summary_blocked(silver, block_days=70)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    blocks = silver.select(day_block("price_date", 70)).distinct().count()
    assert blocks > 10  # against two series
    assert sr.weekly_summary_blocked(silver.limit(0)).count() == 0


def test_reached_blocks(spark):
    rows = spark.createDataFrame([("a", b) for b in (1, 1, 2, 3, 3, 5, 9)], f"k string, {BLOCK} long")
    changed = spark.createDataFrame([("a", 2)], f"k string, {BLOCK} long")
    reach = lambda n, **kw: sorted(r[1] for r in reached_blocks(rows, changed, ["k"], n, **kw).collect())
    assert reach(1) == [2, 3] and reach(2) == [2, 3] and reach(3) == [2, 3, 5] and reach(4) == [2, 3, 5, 9]
    assert reach(1, backward=True) == [1, 2]
    gone = spark.createDataFrame([("a", 4)], f"k string, {BLOCK} long")  # the block has lost all rows
    assert sorted(r[1] for r in reached_blocks(rows, gone, ["k"], 1).collect()) == [4, 5]


def as_rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_incremental_layers_equal_a_full_rebuild(spark, tmp_dir, monkeypatch):
    cfg = Config()
    records = adapter.price_records(spark, SF_SMALL)
    weeks = sorted(r.period for r in records.select("period").distinct().collect())
    layers = IncrementalLayers(spark, tmp_dir + "/inc", cfg, block_days=70)
    late, revised, broken, gone = weeks[3:6], weeks[120], weeks[200], weeks[60:85]
    first = records.filter(~F.col("period").isin(late))
    layers.load(first, 0, as_of="2026-01-01")
    value = F.when(F.col("period") == revised, F.lit("9.875")).when(F.col("period").isin(broken, *gone), F.lit("n/a")).otherwise(F.col("value"))
    second = records.filter(F.col("period").isin(*late, revised, broken, *gone)).withColumn("value", value)

    # a run that dies after silver is repeated whole
    real = IncrementalLayers._refresh
    with monkeypatch.context() as m:
        m.setattr(IncrementalLayers, "_refresh", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            layers.load(second, 1, as_of="2026-01-08")
    assert IncrementalLayers._refresh is real
    before = layers.gold["weekly"].head()
    touched = layers.load(second, 1, as_of="2026-01-08")
    after = layers.gold["weekly"].head()

    final = first.unionByName(second.filter(F.col("period").isin(late))).withColumn("value", value)
    silver = silver_prices(pages.bronze_records(final, cfg, "2026-01-08"), cfg)
    assert as_rows(layers.read("weekly")) == as_rows(sr.weekly_summary(silver, cfg))
    assert as_rows(layers.read("regional")) == as_rows(sr.regional_comparison(silver, cfg))
    assert as_rows(layers.silver.read().drop("block")) == as_rows(silver)
    kept = [p for p, c in after.parts.items() if before.parts.get(p) == c]
    assert len(touched["weekly"]) < len(before.parts) and len(kept) >= len(before.parts) - len(touched["weekly"])
    assert layers.load(second, 1, as_of="2026-01-09") and layers.gold["weekly"].head() == after  # again: nothing changes
    assert layers.load(second.limit(0), 2)["weekly"] == []
