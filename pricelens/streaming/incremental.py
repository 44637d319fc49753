"""Incremental bronze refresh from landed page files (Structured Streaming).

The reference reloads everything each week and notes a keyed merge as the
intended incremental path.  Here new page files in a landing folder are
picked up by a file stream; each micro-batch is flattened, filtered to the
tracked products and merged into the bronze table by record key (the newer
load wins).  The stream's checkpoint lives under the shared
``spark.checkpoint.dir``, so a restarted or failed run resumes with the
files it has not yet committed; re-running a batch gives the same table.
A page that cannot be read whole (truncated, not JSON, no record array) stops
the stream before its batch is merged.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pricelens.config import DEFAULT, Config
from pricelens.plans.incremental import IncrementalLayers
from pricelens.session import scratch_path
from pricelens.sources import pages as pg
from pricelens.sources import tables as tb

RECORD_KEY = ["period", "product", "duoarea", "series"]


def merge_into_bronze(batch: DataFrame, table: str, cfg: Config = DEFAULT) -> int:
    """Merge one batch of raw records into ``table`` (created if missing,
    partitioned by period); only the periods in the batch are rewritten."""
    rows = pg.bronze_records(batch, cfg, dedupe=True)
    return tb.merge_partitions(rows, table, RECORD_KEY, partition_col="period")


def stream_pages_to_bronze(spark: SparkSession, landing_dir: str, cfg: Config = DEFAULT,
                           table: str | None = None, checkpoint: str | None = None,
                           max_files_per_trigger: int | None = None):
    """Start an ``availableNow`` stream of landed page files into bronze.

    Returns the started ``StreamingQuery``; call ``awaitTermination()`` to
    wait for the files present at start to be merged.  The table's files are
    swapped per batch, so a session that read the table before should call
    ``spark.catalog.refreshTable(table)`` before reading it again.
    """
    table = table or cfg.table("bronze", "fuel_prices_raw")
    tb.ensure_namespaces(spark, cfg)
    checkpoint = checkpoint or scratch_path(spark, f"streams/{table.replace('.', '_')}")
    reader = spark.readStream.schema(pg.PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.json(landing_dir)

    def each_batch(batch: DataFrame, _epoch: int) -> None:
        pg.require_readable(batch)
        merge_into_bronze(pg.flatten_pages(batch), table, cfg)

    return (landed.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


BATCH_METRICS = "landed_records"


class BatchMetrics(StreamingQueryListener):
    """Counts of every micro-batch, as the stream's progress reports them:
    records in, tracked (of an ingested product), rejected (tracked, but
    without a readable value or period)."""

    def __init__(self):
        self.batches: dict[int, dict[str, int]] = {}
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(BATCH_METRICS)
        if row is not None:
            self.batches[event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def counted(records: DataFrame, name: str | Observation, cfg: Config = DEFAULT) -> DataFrame:
    """``records`` with the counts of ``BatchMetrics`` observed as they pass."""
    tracked = F.col("product").isin(list(cfg.ingest_products))
    unreadable = F.col("value").try_cast("double").isNull() | F.col("period").try_cast("date").isNull()
    return records.observe(name, F.count(F.lit(1)).alias("records"), F.count_if(tracked).alias("tracked"),
                           F.count_if(tracked & unreadable).alias("rejected"))


def stream_pages_to_layers(spark: SparkSession, landing_dir: str, layers: IncrementalLayers, checkpoint: str,
                           cfg: Config = DEFAULT, max_files_per_trigger: int | None = None, writer: str = "stream"):
    """Start an ``availableNow`` stream of landed page files into versioned
    bronze, silver and gold tables.

    A batch is read once: its counts are observed on the way (add a
    ``BatchMetrics`` listener to see them), a broken page fails the job that
    writes it, and no table changes.  Every table keeps the number of the last
    batch of ``writer`` it holds, so a batch that a restarted stream repeats
    completes what is missing and changes nothing else.
    """
    reader = spark.readStream.schema(pg.PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = counted(pg.flatten_pages(pg.readable(reader.json(landing_dir))), BATCH_METRICS, cfg)

    def each_batch(batch: DataFrame, epoch: int) -> None:
        layers.load(batch, epoch, writer=writer)

    return (records.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
