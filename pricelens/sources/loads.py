"""Loads: sets of pages that declare one total, and whether all of it came.

A paging source hands out a load page by page; every page names its load, its
offset and the load's total.  The stop rule of a load is the declared total
against the distinct records found, over all of its pages, however many
batches they came in:

* lost pages are planned offsets (0, page size, 2 x page size, ... below the
  total) that no page has (``first_lost_offset`` is the least of them, -1 without
  any);
* repeated pages have an offset that came before; overlapping records are
  record copies beyond the first;
* a load is complete when no planned page is lost and the distinct records
  reach the total.

``load_report`` computes this from all pages at once, ``streaming.completeness``
from keyed state over micro-batches; both end in ``report_of``.

Records are compared by a 128-bit digest of all fields, aggregated by (load,
digest), so a load with most of the records is spread like any other.

Pages without a load belong to the load null; pages without an offset count as
pages but fill no planned one; a load whose pages declare several totals is
held to the greatest; without any readable total it is never complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.config import DEFAULT
from pricelens.sources import pages as pg
from pricelens.sources.adapter import RECORD_FIELDS

LOAD_PAGE_SCHEMA = T.StructType([
    T.StructField("load", T.StringType()),
    T.StructField("offset", T.StringType()),
    *pg.PAGE_SCHEMA.fields,
])
REPORT_COLUMNS = ("load", "declared_total", "pages_planned", "pages_seen", "pages_repeated", "pages_lost",
                  "first_lost_offset", "records_found", "records_distinct", "records_overlapping", "missing", "complete")


def records_to_load_pages(records: DataFrame, page_size: int = DEFAULT.page_size,
                          pages_per_load: int = 4) -> DataFrame:
    """Records cut into pages (see ``records_to_pages``) and the pages, in
    order, into loads of ``pages_per_load``: (load, offset, response)."""
    paged = pg.numbered_records(records, page_size)
    load, full = F.floor(F.col("page") / pages_per_load), page_size * pages_per_load
    pages = paged.groupBy("page").agg(F.collect_list("rec").alias("data"), F.first("_total").alias("_total"))
    return pages.select(
        load.cast("string").alias("load"),
        ((F.col("page") - load * pages_per_load) * page_size).cast("string").alias("offset"),
        F.struct(F.least(F.lit(full).cast("long"), F.col("_total") - load * full).cast("string").alias("total"),
                 F.col("data")).alias("response"))


def land_load_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write load pages as JSON lines."""
    pages.select(F.to_json(F.struct("load", "offset", "response")).alias("value")).write.mode(mode).text(path)


def read_load_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOAD_PAGE_SCHEMA).json(path)


def record_digest() -> Column:
    """128 bits over all record fields, nulls told from empty text."""
    fields = [F.coalesce(F.concat(F.lit("="), F.col(f"rec.`{c}`")), F.lit("")) for c in RECORD_FIELDS]
    return F.unhex(F.md5(F.to_json(F.array(*fields)).cast("binary")))


def page_facts(pages: DataFrame) -> DataFrame:
    """One row per page: (load, offset, total, n)."""
    return pages.select("load", F.col("offset").try_cast("long").alias("offset"),
                        F.col("response.total").try_cast("long").alias("total"),
                        F.coalesce(F.size("response.data"), F.lit(0)).cast("long").alias("n"))


def record_facts(pages: DataFrame) -> DataFrame:
    """One row per record: (load, digest)."""
    return (pages.select("load", F.explode("response.data").alias("rec"))
            .select("load", record_digest().alias("digest")))


def planned_offsets(totals: DataFrame, page_size: int) -> DataFrame:
    """(load, offset) of every page that a load of (load, declared_total) has."""
    last = F.col("declared_total") - 1
    return (totals.filter(F.col("declared_total") > 0)
            .select("load", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(page_size).cast("long"))).alias("offset")))


def report_of(counts: DataFrame, offsets: DataFrame, page_size: int) -> DataFrame:
    """The report from (load, declared_total, pages, records_found,
    records_distinct) and the seen (load, offset) pairs, distinct."""
    planned = planned_offsets(counts.select("load", "declared_total"), page_size)
    lost = (planned.alias("p").join(offsets.alias("o"), F.col("p.load").eqNullSafe(F.col("o.load"))
                                    & (F.col("p.offset") == F.col("o.offset")), "left_anti")
            .groupBy("load").agg(F.count("*").alias("pages_lost"), F.min("offset").alias("first_lost_offset")))
    seen = offsets.groupBy("load").agg(F.count("offset").alias("pages_seen"))
    joined = counts
    for side in (lost, seen):
        name = side.withColumnRenamed("load", "_load")
        joined = joined.join(name, F.col("load").eqNullSafe(F.col("_load")), "left").drop("_load")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    missing = F.col("declared_total") - F.col("records_distinct")
    return joined.select(
        "load", "declared_total", F.ceil(F.col("declared_total") / page_size).cast("long").alias("pages_planned"),
        zero("pages_seen").alias("pages_seen"), (F.col("pages") - zero("pages_seen")).alias("pages_repeated"),
        zero("pages_lost").alias("pages_lost"),
        F.coalesce("first_lost_offset", F.lit(-1).cast("long")).alias("first_lost_offset"), "records_found", "records_distinct",
        (F.col("records_found") - F.col("records_distinct")).alias("records_overlapping"), missing.alias("missing"),
        (F.coalesce(missing <= 0, F.lit(False)) & (zero("pages_lost") == 0)).alias("complete"))


def load_report(pages: DataFrame, page_size: int = DEFAULT.page_size) -> DataFrame:
    """One row per load (``REPORT_COLUMNS``) from all pages at once.

    The pages are aggregated by (load, offset) and the records by (load,
    digest); both have partial sums before the shuffle."""
    by_offset = page_facts(pages).groupBy("load", "offset").agg(
        F.count("*").alias("copies"), F.max("total").alias("total"), F.sum("n").alias("n"))
    per_load = by_offset.groupBy("load").agg(
        F.max("total").alias("declared_total"), F.sum("copies").alias("pages"), F.sum("n").alias("records_found"))
    distinct = (record_facts(pages).distinct().groupBy("load").agg(F.count("*").alias("_distinct"))
                .withColumnRenamed("load", "_load"))
    counts = (per_load.join(distinct, F.col("load").eqNullSafe(F.col("_load")), "left")
              .select("load", "declared_total", "pages", "records_found",
                      F.coalesce("_distinct", F.lit(0).cast("long")).alias("records_distinct")))
    return report_of(counts, by_offset.filter("offset is not null").select("load", "offset"), page_size)


def require_complete_loads(report: DataFrame) -> None:
    """Fail and name the first loads that are not complete."""
    broken = report.filter(~F.col("complete")).orderBy("load").limit(5).collect()
    if broken:
        raise ValueError(f"incomplete loads: {[r.asDict() for r in broken]}")
