"""``paged_records``: a Spark data source over landed pages of a load.

    register_page_source(spark)
    spark.read.format("paged_records").option("path", folder).load().filter("product = 'EPMR'")

A folder holds one JSON document per page, ``{"load", "offset", "response":
{"total", "data"}}``, in ``load=<load>/offset=<offset>/*.txt`` (``land_paged``
writes it).  Planning lists the folders and reads the first bytes of one page
of each load for its declared total: every offset 0, page size, ... below it
must be there, otherwise the read fails and names the lost offsets.  Each page
is one partition; its task fails where the page is broken, holds fewer records
than its place asks for, or declares another total.  The driver never reads a
page's records.

Filters that compare one column with constants (=, <=>, <, <=, >, >=, in,
is null, is not null, starts with) are pushed: a page's reader drops the records
that fail them before they become rows.  Spark evaluates the others.

Options: ``path``; ``page_size`` (offsets are its multiples); ``complete``
(``false`` reads what is there).  Files are opened through pyarrow's file
systems, so the folder may be a local path or a URI that these know; a store
that only Spark reaches is read with ``loads.read_load_pages``.

A page that comes twice is read once (the first file by name).
"""

from __future__ import annotations

import json
import re
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from pricelens.config import DEFAULT
from pricelens.sources.adapter import RECORD_FIELDS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELDS, PAGE_SIZE = tuple(RECORD_FIELDS), DEFAULT.page_size
SCHEMA = ", ".join(f"`{f}` string" for f in FIELDS)

PLACE = re.compile(r"/load=([^/]+)/offset=(\d+)/[^/]+$")
TOTAL = re.compile(rb'"total"\s*:\s*"?(\d+)')
HEAD_BYTES = 4096

# a record passes where the test holds; a null fails every comparison
TESTS = {
    EqualTo: lambda x, f: x is not None and x == f.value,
    EqualNullSafe: lambda x, f: x == f.value,
    GreaterThan: lambda x, f: x is not None and x > f.value,
    GreaterThanOrEqual: lambda x, f: x is not None and x >= f.value,
    LessThan: lambda x, f: x is not None and x < f.value,
    LessThanOrEqual: lambda x, f: x is not None and x <= f.value,
    In: lambda x, f: x is not None and x in f.value,
    IsNull: lambda x, f: x is None,
    IsNotNull: lambda x, f: x is not None,
    StringStartsWith: lambda x, f: x is not None and x.startswith(f.value),
}


def _filesystem(path: str):
    import os

    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path))


class Page(InputPartition):
    """One page: its file, and the records it must hold (-1: as many as come)."""

    def __init__(self, file: str, total: int, expected: int):
        super().__init__(file)
        self.file, self.total, self.expected = file, total, expected


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("paged_records needs the option path")
        self.page_size = int(options.get("page_size", PAGE_SIZE))
        self.complete = str(options.get("complete", "true")).lower() == "true"
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in TESTS and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.filters.append(f)
            else:
                yield f

    def _pages(self) -> dict[str, dict[int, str]]:
        """load -> offset -> file, from the names alone."""
        from pyarrow import fs
        store, root = _filesystem(self.path)
        found: dict[str, dict[int, str]] = {}
        for i in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            place = PLACE.search(i.path)
            if i.is_file and place and i.size and not i.base_name.startswith(("_", ".")):
                found.setdefault(place[1], {}).setdefault(int(place[2]), i.path)
        return found

    def _total(self, file: str) -> int:
        """The declared total, which stands in front of a page's records."""
        store, _ = _filesystem(self.path)
        with store.open_input_stream(file) as f:
            declared = TOTAL.search(f.read(HEAD_BYTES))
        if not declared:
            raise ValueError(f"{file} cannot be read: no declared total at its start")
        return int(declared[1])

    def partitions(self):
        pages, lost = [], []
        for load, files in sorted(self._pages().items()):
            total = self._total(files[min(files)])
            lost += [(load, at) for at in range(0, total, self.page_size) if at not in files]
            pages += [Page(f, total, min(self.page_size, total - at) if self.complete else -1)
                      for at, f in sorted(files.items())]
        if self.complete and lost:
            raise ValueError(f"{len(lost)} pages are lost, the first at (load, offset) {lost[:5]}")
        return pages

    def read(self, partition: Page):
        store, _ = _filesystem(self.path)
        try:
            with store.open_input_stream(partition.file) as f:
                response = json.loads(f.read())["response"]
            data, total = response["data"], int(response["total"])
        except (ValueError, KeyError, TypeError) as e:
            raise ValueError(f"{partition.file} cannot be read: {e!r}") from None
        if partition.expected >= 0 and (len(data) < partition.expected or total != partition.total):
            raise ValueError(f"{partition.file} holds {len(data)} of {partition.expected} records and declares "
                             f"{total}, not {partition.total}")
        checks = [(f.attribute[0], TESTS[type(f)], f) for f in self.filters]
        for record in data:
            if all(test(record.get(name), f) for name, test, f in checks):
                yield tuple(record.get(c) for c in FIELDS)


class PagedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def register_page_source(spark: SparkSession) -> None:
    """Make ``paged_records`` known to the session and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedRecords)


def land_paged(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write load pages (load, offset, response), one file for each page."""
    one = pages.repartition("load", "offset")
    (one.select("load", "offset", F.to_json(F.struct("load", "offset", "response")).alias("value"))
     .write.mode(mode).partitionBy("load", "offset").text(path))
