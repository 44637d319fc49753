"""Completeness of loads over micro-batches, by keyed state.

Pages of a load arrive in any order, over several batches and restarts.  Every
page and every record is keyed by (load, bucket), the bucket coming from the
page's offset or the record's digest; ``transformWithState`` keeps per key the
offsets and digests seen so far and the counts of all that came.  A load with
most of the records is spread over all ``buckets``; the state of one key is
about distinct records / buckets digests of 16 bytes.

After each batch the touched keys' counts (so far) and new offsets are written
to ``<report dir>/epoch=<n>``, overwriting that folder, so a repeated batch
writes the same rows again.  ``stream_load_report`` reads the newest counts of
every key and gives the same report as the batch operator.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from pricelens.config import DEFAULT, Config
from pricelens.session import scratch_path
from pricelens.sources import loads as ld

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 256
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = "load string, bucket int, declared_total long, pages long, records_found long, records_distinct long, new_offsets array<long>"
ITEM = 16  # bytes of a digest; an offset takes the last 8


class SeenSoFar(StatefulProcessor):
    """State of one (load, bucket): sorted items seen, counts."""

    def init(self, handle) -> None:
        self.items = handle.getValueState("items", "digests binary, offsets binary")
        self.counts = handle.getValueState("counts", "declared_total long, pages long, found long")

    def handleInputRows(self, key, rows, timerValues):
        digests, offsets = self.items.get() if self.items.exists() else (b"", b"")
        total, pages, found = self.counts.get() if self.counts.exists() else (None, 0, 0)
        seen = np.frombuffer(bytes(digests), f"S{ITEM}") if digests else np.zeros(0, f"S{ITEM}")
        known = np.frombuffer(bytes(offsets), np.int64)
        new_offsets = np.zeros(0, np.int64)
        for part in rows:
            of_page = part["digest"].isna().to_numpy()
            page = part[of_page]
            pages += len(page)
            declared = page["total"].dropna()
            if len(declared):
                total = max(int(declared.max()), total if total is not None else -1)
            fresh = np.setdiff1d(page["offset"].dropna().to_numpy(np.int64), np.concatenate((known, new_offsets)))
            new_offsets = np.concatenate((new_offsets, fresh))
            found += int((~of_page).sum())
            # fixed-width bytes drop trailing zeros alike on both sides
            seen = np.union1d(seen, np.array(part["digest"][~of_page].map(bytes).tolist(), f"S{ITEM}"))
        known = np.union1d(known, new_offsets)
        self.items.update((seen.astype(f"S{ITEM}").tobytes(), known.astype(np.int64).tobytes()))
        self.counts.update((total, pages, found))
        yield pd.DataFrame({"load": [key[0]], "bucket": [key[1]],
                            "declared_total": pd.array([total], "Int64"), "pages": [pages],
                            "records_found": [found], "records_distinct": [len(seen)],
                            "new_offsets": [new_offsets.tolist()]})

    def close(self) -> None:
        pass


def keyed_facts(pages: DataFrame, buckets: int, page_size: int) -> DataFrame:
    """Pages and records as rows (load, bucket, offset, total, digest): a row
    with a digest is a record, any other a page."""
    page = F.struct(F.col("offset").try_cast("long").alias("offset"),
                    F.col("response.total").try_cast("long").alias("total"), F.lit(None).cast("binary").alias("digest"))
    none = F.lit(None).cast("long")
    records = F.transform(F.coalesce("response.data", F.array()), lambda r: F.struct(
        none.alias("offset"), none.alias("total"), F.lit(None).cast("binary").alias("digest"), r.alias("rec")))
    both = F.concat(F.array(F.struct(*[page[c].alias(c) for c in ("offset", "total", "digest")],
                                     F.lit(None).cast(ld.pg.RECORD_SCHEMA).alias("rec"))), records)
    rows = pages.select("load", F.posexplode(both).alias("_at", "_x")).select("load", "_at", "_x.offset", "_x.total", "_x.rec")
    digest = F.when(F.col("_at") > 0, ld.record_digest())
    bucket = F.when(F.col("_at") > 0, F.pmod(F.xxhash64("digest"), F.lit(buckets))).otherwise(
        F.pmod(F.floor(F.coalesce("offset", F.lit(0)) / page_size), F.lit(buckets)))
    return (rows.withColumn("digest", digest)
            .select("load", bucket.cast("int").alias("bucket"), "offset", "total", "digest"))


def track_loads(spark: SparkSession, landing_dir: str, report_dir: str, cfg: Config = DEFAULT,
                checkpoint: str | None = None, buckets: int = BUCKETS, max_files_per_trigger: int | None = None):
    """Start an ``availableNow`` stream over landed load pages that keeps the
    report below ``report_dir``.  ``buckets`` must stay the same for a
    checkpoint.  Sets the session's state store to RocksDB, which this kind
    of state needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(ld.LOAD_PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = (keyed_facts(reader.json(landing_dir), buckets, cfg.page_size).groupBy("load", "bucket")
              .transformWithStateInPandas(SeenSoFar(), COUNTS, "Update", "None"))

    def each_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{report_dir}/epoch={epoch}")
    return (counts.writeStream.outputMode("update").foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "streams/load_report"))
            .trigger(availableNow=True).start())


def stream_load_report(spark: SparkSession, report_dir: str, cfg: Config = DEFAULT) -> DataFrame:
    """The report (``loads.REPORT_COLUMNS``) of everything tracked so far."""
    rows = spark.read.schema(f"{COUNTS}, epoch long").parquet(report_dir)
    now = (rows.groupBy("load", "bucket")
           .agg(F.max_by(F.struct("declared_total", "pages", "records_found", "records_distinct"), "epoch").alias("c"))
           .select("load", "c.*"))
    counts = now.groupBy("load").agg(F.max("declared_total").alias("declared_total"), *[
        F.sum(c).alias(c) for c in ("pages", "records_found", "records_distinct")])
    offsets = rows.select("load", F.explode("new_offsets").alias("offset")).distinct()
    return ld.report_of(counts, offsets, cfg.page_size)
