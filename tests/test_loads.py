"""Completeness of loads: the batch report, and keyed state over batches and a restart."""

import os

import pytest
from pyspark.sql import functions as F

from pricelens.config import Config
from pricelens.sources import adapter, loads
from pricelens.streaming.completeness import stream_load_report, track_loads

from conftest import SF_SMALL

CFG = Config(page_size=300)


@pytest.fixture(scope="module")
def pages(spark):
    from pricelens.session import materialize
    return materialize(loads.records_to_load_pages(adapter.price_records(spark, SF_SMALL), CFG.page_size, 3))


def rows(df):
    return {r.load: r.asDict() for r in df.select(*loads.REPORT_COLUMNS).collect()}


def test_whole_loads_are_complete(spark, pages):
    got = rows(loads.load_report(pages, CFG.page_size))
    assert len(got) > 3 and all(r["complete"] and r["pages_lost"] == 0 and r["missing"] == 0 for r in got.values())
    assert sum(r["records_distinct"] for r in got.values()) == adapter.price_records(spark, SF_SMALL).count()
    loads.require_complete_loads(loads.load_report(pages, CFG.page_size))


def test_lost_and_repeated_pages_are_named(spark, pages):
    lost = (F.col("load") == "1") & (F.col("offset") == "300")
    again = pages.filter("load = '2' and offset = '0'")
    got = rows(loads.load_report(pages.filter(~lost).unionByName(again), CFG.page_size))
    assert (got["1"]["pages_lost"], got["1"]["first_lost_offset"], got["1"]["missing"], got["1"]["complete"]) == (1, 300, 300, False)
    assert (got["2"]["pages_repeated"], got["2"]["records_overlapping"], got["2"]["complete"]) == (1, 300, True)
    with pytest.raises(ValueError, match="incomplete loads"):
        loads.require_complete_loads(loads.load_report(pages.filter(~lost), CFG.page_size))


def test_odd_pages(spark):
    schema = loads.LOAD_PAGE_SCHEMA
    got = rows(loads.load_report(spark.createDataFrame(
        [("a", "0", None), (None, "0", ("0", [])), ("b", None, ("x", None)), ("c", "zero", ("2", []))], schema), 300))
    assert set(got) == {"a", None, "b", "c"}
    assert [got[k]["complete"] for k in ("a", None, "b", "c")] == [False, True, False, False]
    assert got["c"]["pages_lost"] == 1 and got["b"]["declared_total"] is None
    assert loads.load_report(spark.createDataFrame([], schema), 300).count() == 0


def test_stream_equals_batch_over_batches_and_a_restart(spark, pages, tmp_dir):
    landing, report, ck = (os.path.join(tmp_dir, n) for n in ("landing", "report", "ck"))
    held_back = F.col("offset") == "300"
    lost = (F.col("load") == "1") & (F.col("offset") == "600")

    def run():
        q = track_loads(spark, landing + "/*", report, CFG, checkpoint=ck, buckets=4, max_files_per_trigger=2)
        q.awaitTermination()
        assert q.exception() is None
        return rows(stream_load_report(spark, report, CFG))
    loads.land_load_pages(pages.filter(~held_back & ~lost).repartition(3), landing + "/a")
    first = run()
    assert not any(r["complete"] for k, r in first.items() if r["pages_planned"] > 1)
    loads.land_load_pages(pages.filter(held_back).unionByName(pages.filter("load = '0' and offset = '0'")), landing + "/b")
    second = run()  # a new query on the same checkpoint
    assert second == rows(loads.load_report(pages.filter(~lost).unionByName(pages.filter("load = '0' and offset = '0'")), 300))
    assert [k for k, r in second.items() if not r["complete"]] == ["1"] and second["0"]["records_overlapping"] == 300
    assert run() == second  # nothing new landed
    loads.land_load_pages(pages.filter(lost), landing + "/c")
    assert all(r["complete"] for r in run().values())
