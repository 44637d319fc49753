"""The paged_records data source: completeness at planning, one partition a page, pushed filters."""

import contextlib
import glob
import io
import json
import os

import pytest

from pricelens.session import materialize
from pricelens.sources import adapter, loads
from pricelens.sources.page_source import FIELDS, land_paged, register_page_source

from conftest import SF_SMALL

SIZE = 700


@pytest.fixture(scope="module")
def records(spark):
    register_page_source(spark)
    return materialize(adapter.price_records(spark, SF_SMALL))


@pytest.fixture()
def folder(records, tmp_dir):
    path = os.path.join(tmp_dir, "pages")
    land_paged(loads.records_to_load_pages(records, SIZE, 4), path)
    return path


def read(spark, path, **options):
    return spark.read.format("paged_records").options(path=path, page_size=SIZE, **options).load()


def rows(df):
    return sorted(map(repr, df.select(*[f"`{c}`" for c in FIELDS]).collect()))


def test_reads_all_records_one_partition_a_page(spark, records, folder):
    df = read(spark, folder)
    assert rows(df) == rows(records)
    assert df.rdd.getNumPartitions() == -(-records.count() // SIZE)


@pytest.mark.parametrize("where", ["product = 'EPMR'", "product in ('EPMR', 'EPM0') and period >= '1996-01-01'", "value is null",
                                   "value = 'n/a' or period < '1993-01-01'", "series like 'EPMR%' and duoarea <> 'NUS'"])
def test_filters_give_the_same_rows(spark, records, folder, where):
    assert rows(read(spark, folder).filter(where)) == rows(records.filter(where))


def test_filters_show_as_pushed(spark, folder):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        read(spark, folder).filter("product = 'EPMR' and length(value) > 2").explain("formatted")
    scan, _, above = out.getvalue().partition("Pushed")
    assert "EPMR" in above.splitlines()[0]
    assert read(spark, folder).filter("product = 'nothing'").count() == 0


def pages_of(folder):
    return sorted(glob.glob(folder + "/load=*/offset=*/part-*"))


def rewrite(file, text):
    open(file, "w").write(text)
    for crc in glob.glob(os.path.dirname(file) + "/.*.crc"):
        os.remove(crc)


def test_a_lost_page_fails_at_planning(spark, records, folder):
    os.remove(glob.glob(folder + f"/load=1/offset={SIZE}/part-*")[0])
    with pytest.raises(Exception, match=f"1 pages are lost, the first at .*'1', {SIZE}"):
        read(spark, folder).count()
    assert read(spark, folder, complete="false").count() == records.count() - SIZE


def test_a_short_or_broken_page_fails_in_its_task(spark, folder):
    file = pages_of(folder)[1]
    page = json.loads(open(file).read())
    page["response"]["data"].pop()
    rewrite(file, json.dumps(page))
    with pytest.raises(Exception, match=f"holds {SIZE - 1} of {SIZE} records"):
        read(spark, folder).count()
    rewrite(file, open(file).read()[:-40])
    with pytest.raises(Exception, match="cannot be read"):
        read(spark, folder).count()


def test_a_page_that_comes_twice_is_read_once(spark, records, folder):
    file = pages_of(folder)[0]
    rewrite(os.path.dirname(file) + "/part-zz.txt", open(file).read())
    assert rows(read(spark, folder)) == rows(records)
