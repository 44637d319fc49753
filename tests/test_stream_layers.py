"""Landed pages into versioned layers: counts per batch, broken pages, repeated batches."""

import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.operators import series as sr
from pricelens.operators.silver import silver_prices
from pricelens.plans.incremental import IncrementalLayers
from pricelens.session import materialize
from pricelens.sources import adapter, pages
from pricelens.streaming.incremental import BatchMetrics, stream_pages_to_layers

from conftest import SF_SMALL


def test_stream_into_layers(spark, tmp_dir):
    cfg = Config()
    records = materialize(adapter.price_records(spark, SF_SMALL))
    landing, ck = tmp_dir + "/landing", tmp_dir + "/ck"
    layers = IncrementalLayers(spark, tmp_dir + "/tables", cfg)
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)

    def run():
        q = stream_pages_to_layers(spark, landing + "/*", layers, ck, cfg)
        q.awaitTermination()
        assert metrics.ended.wait(30)

    def land(rows, name):
        pages.land_pages(pages.records_to_pages(rows, 1000), f"{landing}/{name}")

    def versions():
        return [t.head().version for t in (layers.bronze, layers.silver, *layers.gold.values())]
    try:
        late = F.col("period") < "1993-06-01"
        land(records.filter(~late), "a")
        run()
        n = records.filter(~late).count()
        tracked = records.filter(~late & F.col("product").isin(list(cfg.ingest_products)))
        rejected = tracked.filter(F.col("value").try_cast("double").isNull()).count()
        assert metrics.batches[0] == {"records": n, "tracked": tracked.count(), "rejected": rejected}
        assert n > tracked.count() and rejected > 0

        # a broken page: the batch fails and no table changes
        before = versions()
        os.makedirs(landing + "/broken")
        with open(landing + "/broken/cut.json", "w") as f:
            f.write('{"response": {"total": "3", "da')
        land(records.filter(late), "b")
        with pytest.raises(StreamingQueryException):
            run()
        assert versions() == before

        # the page is mended under its name; the same batch is repeated
        part = [p for p in os.listdir(landing + "/b") if p.startswith("part-")][0]
        shutil.copyfile(f"{landing}/b/{part}", landing + "/broken/cut.json")
        run()
        silver = silver_prices(pages.bronze_records(records, cfg, "2026-01-01"), cfg)
        for name, want in (("weekly", sr.weekly_summary(silver, cfg)), ("regional", sr.regional_comparison(silver, cfg))):
            got = layers.read(name)
            assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        done = versions()
        run()  # nothing new
        assert versions() == done

        # a stream that lost its checkpoint repeats batch 0 and 1: they are known
        shutil.copytree(landing, tmp_dir + "/again")
        q = stream_pages_to_layers(spark, tmp_dir + "/again/*", layers, tmp_dir + "/ck2", cfg)
        q.awaitTermination()
        assert versions() == done
    finally:
        spark.streams.removeListener(metrics)
