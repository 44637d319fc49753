"""Paged JSON record source.

A price API hands out records in pages: ``{"response": {"total": "...",
"data": [record, ...]}}``.  Pages are landed as files (one JSON document per
line, or one per file with ``multi_line=True``) and read back in parallel:
every file split is a task, ``inline`` flattens the record arrays, and page
bookkeeping (declared total vs rows found, overlapping pages) is computed
with aggregations, never on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.config import DEFAULT, Config
from pricelens.functions.dates import as_of_column
from pricelens.session import materialize
from pricelens.sources.adapter import RECORD_FIELDS

# Every record field is text: typing happens in the silver layer, so a bad
# value never fails the load and never makes schema inference guess.
RECORD_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS])
PAGE_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("total", T.StringType()),
        T.StructField("data", T.ArrayType(RECORD_SCHEMA)),
    ])),
])


def page_offsets(spark: SparkSession, total: int, page_size: int = DEFAULT.page_size) -> DataFrame:
    """The page plan for ``total`` rows: (page, offset, length), made up front."""
    return (spark.range(0, max(int(total), 0), page_size)
            .select((F.col("id") / page_size).cast("long").alias("page"),
                    F.col("id").alias("offset"),
                    F.least(F.lit(page_size).cast("long"), F.lit(int(total)) - F.col("id")).alias("length")))


def numbered_records(records: DataFrame, page_size: int) -> DataFrame:
    """(page, _total, rec): every record with its page, numbered as described
    at ``records_to_pages``."""
    fixed = materialize(records)
    mask = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | position
    numbered = fixed.select(
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(mask)).alias("_pos"),
        F.struct(*[F.col(f"`{c}`") for c in RECORD_FIELDS]).alias("rec"))
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per input partition: a global window over it is bounded
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"))
    return (numbered.join(F.broadcast(offsets), "_part")
             .select(((F.col("_offset") + F.col("_pos")) / F.lit(page_size)).cast("long").alias("page"),
                     "_total", "rec"))


def records_to_pages(records: DataFrame, page_size: int = DEFAULT.page_size) -> DataFrame:
    """Group records into page documents of at most ``page_size`` records
    (exactly ceil(total / page_size) pages), as a paging API hands them out.

    Records are numbered without a global sort: the input is materialized
    (so its partitions and their order are fixed and a retried task sees the
    same rows), each partition is counted, the partition offsets are a prefix
    sum over those per-partition counts (one row per partition), and a
    record's number is its partition offset plus its position.  Page =
    number / page_size, so a page never exceeds ``page_size`` records, even
    when one record is copied very many times.
    """
    paged = numbered_records(records, page_size)
    return (paged.groupBy("page")
            .agg(F.collect_list("rec").alias("data"), F.first("_total").alias("_total"))
            .select("page", F.struct(F.col("_total").cast("string").alias("total"),
                                     F.col("data")).alias("response")))


def land_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write page documents as JSON lines (one page per line)."""
    pages.select(F.to_json(F.struct("response")).alias("value")).write.mode(mode).text(path)


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read landed page documents with the fixed page schema (no inference)."""
    reader = spark.read.schema(PAGE_SCHEMA)
    if multi_line:
        reader = reader.option("multiLine", True)
    return reader.json(path).withColumn("page_file", F.input_file_name())


def parse_page_text(texts: DataFrame, column: str = "value") -> DataFrame:
    """Page documents held as JSON text in ``column`` -> page structs."""
    return texts.select(F.from_json(F.col(column), PAGE_SCHEMA)["response"].alias("response"))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Page documents -> one row per record (all text fields)."""
    return pages.select(F.inline("response.data")).select(
        *[F.col(f"`{c}`") for c in RECORD_FIELDS])


def page_report(pages: DataFrame) -> DataFrame:
    """One row: pages read, declared total, records found, distinct records,
    and ``missing`` = total - distinct (positive when pages were lost)."""
    per_page = pages.select(
        F.col("response.total").try_cast("long").alias("total"),
        F.coalesce(F.size("response.data"), F.lit(0)).alias("n"))
    distinct = flatten_pages(pages).distinct().agg(F.count(F.lit(1)).alias("d")).scalar()
    return per_page.agg(
        F.count(F.lit(1)).alias("pages"),
        F.max("total").alias("declared_total"),
        F.sum("n").cast("long").alias("records_found"),
    ).select("*", distinct.alias("distinct_records"),
             (F.col("declared_total") - distinct).alias("missing"))


def require_complete(pages: DataFrame) -> dict:
    """Fail when the pages hold fewer distinct records than they declare
    (a lost or short page), instead of loading a silent subset.  Returns
    the one-row page report as a dict."""
    require_readable(pages)
    report = page_report(pages).first().asDict()
    if report["missing"] is None or report["missing"] > 0:
        raise ValueError(f"incomplete page set: {report}")
    return report


def require_readable(pages: DataFrame) -> None:
    """Fail when a page has no record array: a truncated or foreign document
    parses to nulls and its records would vanish without an error."""
    broken = pages.filter(F.col("response.data").isNull()).count()
    if broken:
        raise ValueError(f"{broken} landed pages cannot be read")


def readable(pages: DataFrame) -> DataFrame:
    """``pages`` with a check in the plan: the job that reads them fails at a
    page without a record array (see ``require_readable``, which scans)."""
    data = F.col("response.data")
    checked = F.when(data.isNull(), F.raise_error(F.lit("a landed page cannot be read"))).otherwise(data)
    return pages.withColumn("response", F.struct(F.col("response.total").alias("total"), checked.alias("data")))


def bronze_records(records: DataFrame, cfg: Config = DEFAULT, as_of=None,
                   source: str | None = None, dedupe: bool = True) -> DataFrame:
    """Raw records -> bronze rows: tracked products only, exact copies from
    overlapping pages removed (``dedupe``; a hash aggregation that combines
    map-side), load time and source tag added.  Records that come from an
    aggregation instead of pages cannot overlap and skip that shuffle."""
    loaded = records.filter(F.col("product").isin(list(cfg.ingest_products)))
    if dedupe:
        loaded = loaded.dropDuplicates()
    load_time = (F.current_timestamp() if as_of is None
                 else as_of_column(as_of).cast("timestamp"))
    return loaded.withColumns({
        "_ingested_at": load_time,
        "_source": F.lit(source or cfg.source_tag),
    })


def paged_ingest(pages: DataFrame, cfg: Config = DEFAULT, as_of=None) -> DataFrame:
    """B-01: page documents -> bronze rows."""
    return bronze_records(flatten_pages(pages), cfg, as_of)
