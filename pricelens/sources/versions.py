"""Partitioned tables whose changes appear all at once.

A table is a folder:

* ``data/commit=<id>/<column>=<value>/*.parquet``: partitions as some commit
  wrote them, never changed afterwards;
* ``_manifest/<version>.json``: per partition the commit that holds it now,
  the schema, and per writer the last batch it put in.

A change is staged as a new commit folder and becomes visible when its
manifest is renamed into place, one file.  A run that dies before that leaves
the table as it was, and its staged files are unreferenced; a batch that comes
again is found in the manifest and changes nothing; of two writers that start
from one version the second fails.  (Renaming must not replace a file, as on
HDFS and POSIX; an object store needs a committer that has this.)

Only the touched partitions are read and written.  The manifest has one entry
per partition, and the driver handles names of partitions only, never rows.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.evolution import conform, reconcile
from pricelens.sources.tables import keyed_upsert


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    schema: T.StructType | None = None
    parts: dict[str, str] = field(default_factory=dict)    # partition folder -> commit
    batches: dict[str, int] = field(default_factory=dict)  # writer -> last batch

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "parts": self.parts,
                           "batches": self.batches})

    @staticmethod
    def from_json(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["version"], T.StructType.fromJson(d["schema"]), d["parts"], d["batches"])


class ConflictError(RuntimeError):
    """Another writer took the version."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        self.spark, self.path, self.col = spark, path.rstrip("/"), partition_col
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- files ---------------------------------------------------------------

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._at("").getFileSystem(self._conf)

    def _names(self, folder: str) -> dict[str, float]:
        """Names below a folder and when they changed."""
        at = self._at(folder)
        return {s.getPath().getName(): s.getModificationTime() / 1000
                for s in (self._fs.listStatus(at) if self._fs.exists(at) else [])}

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_manifest") if n.endswith(".json"))

    def _load(self, version: int) -> Manifest:
        stream = self._fs.open(self._at(f"_manifest/{version:010d}.json"))
        try:
            return Manifest.from_json(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self) -> Manifest:
        """The newest manifest (an empty one before the first commit)."""
        versions = self._versions()
        return self._load(versions[-1]) if versions else Manifest()

    def _switch(self, manifest: Manifest) -> None:
        """Put the manifest in place in one step; fails where the version is taken."""
        final, draft = self._at(f"_manifest/{manifest.version:010d}.json"), self._at(f"_manifest/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(manifest.to_json().encode()))
        out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        qualified = self._fs.makeQualified
        try:
            files.rename(qualified(draft), qualified(final), options)
        except Exception as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise ConflictError(f"version {manifest.version} of {self.path} is taken") from None
            raise

    # --- reads ---------------------------------------------------------------

    def folder_of(self, value) -> str:
        """Name of the folder of a partition value, as Spark writes it."""
        if value is None or value == "":
            return f"{self.col}=__HIVE_DEFAULT_PARTITION__"
        return f"{self.col}=" + self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))

    def read(self, version: int | None = None, values: list | None = None) -> DataFrame:
        """The table, or its partitions of ``values`` only, at a version."""
        m = self.head() if version is None else self._load(version)
        if m.schema is None:
            raise AnalysisException(f"{self.path} has no version yet")
        wanted = m.parts if values is None else {p: m.parts[p] for v in values if (p := self.folder_of(v)) in m.parts}
        if not wanted:
            return self.spark.createDataFrame([], m.schema)
        files = [f"{self.path}/data/commit={c}/{p}" for p, c in sorted(wanted.items())]
        rows = (self.spark.read.schema(T.StructType([*m.schema.fields, T.StructField("commit", T.StringType())]))
                .option("basePath", f"{self.path}/data").parquet(*files))
        return rows.select(*[F.col(f"`{f.name}`") for f in m.schema])

    # --- changes -------------------------------------------------------------

    def _done(self, m: Manifest, batch: tuple[str, int] | None) -> bool:
        return batch is not None and m.batches.get(batch[0], -1) >= batch[1]

    def _commit(self, m: Manifest, rows: DataFrame, schema: T.StructType, dropped: list[str],
                batch: tuple[str, int] | None) -> Manifest:
        commit = uuid.uuid4().hex
        folder = f"data/commit={commit}"
        (conform(rows, schema).repartition(F.col(f"`{self.col}`")).write.partitionBy(self.col).parquet(f"{self.path}/{folder}"))
        written = [n for n in self._names(folder) if n.startswith(f"{self.col}=")]
        parts = {p: c for p, c in m.parts.items() if p not in set(dropped)} | dict.fromkeys(written, commit)
        new = replace(m, version=m.version + 1, schema=schema, parts=parts,
                      batches=m.batches | ({batch[0]: batch[1]} if batch else {}))
        self._switch(new)
        return new

    def _schema_with(self, m: Manifest, rows: DataFrame) -> T.StructType:
        new = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
        return new if m.schema is None else reconcile(m.schema, new)

    def overwrite(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> Manifest:
        """Replace the whole table; columns follow ``evolution.reconcile``."""
        m = self.head()
        if self._done(m, batch):
            return m
        return self._commit(m, rows, self._schema_with(m, rows), [*m.parts], batch)

    def replace_partitions(self, rows: DataFrame, values: list, batch: tuple[str, int] | None = None) -> Manifest:
        """Replace the partitions of ``values`` by ``rows``, which lie in them
        (values without rows become empty)."""
        m = self.head()
        if self._done(m, batch):
            return m
        return self._commit(m, rows, self._schema_with(m, rows), [self.folder_of(v) for v in values], batch)

    def merge(self, updates: DataFrame, keys: list[str], order_col: str = "_ingested_at",
              batch: tuple[str, int] | None = None) -> Manifest:
        """Keyed upsert of ``updates`` (see ``tables.keyed_upsert``); the key
        includes the partition column, so a row stays in its partition."""
        if self.col not in keys:
            raise ValueError(f"the key must hold the partition column {self.col}")
        m = self.head()
        if self._done(m, batch):
            return m
        schema = self._schema_with(m, updates)
        touched = [r[0] for r in updates.select(F.col(f"`{self.col}`")).distinct().collect()]  # partition values
        new = conform(updates, schema)
        old = conform(self.read(m.version, touched), schema) if m.schema is not None else new.limit(0)
        return self._commit(m, keyed_upsert(old, new, keys, order_col), schema, [self.folder_of(v) for v in touched], batch)

    def vacuum(self, keep: int = 2, min_age_s: float = 3600.0) -> list[str]:
        """Delete manifests but the newest ``keep`` and commits that none of
        these refers to; folders younger than ``min_age_s`` may be staged by a
        running writer and stay.  Returns the deleted commits."""
        versions = self._versions()
        for v in versions[:-keep]:
            self._fs.delete(self._at(f"_manifest/{v:010d}.json"), False)
        used = {c for v in versions[-keep:] for c in self._load(v).parts.values()}
        old = [n for n, t in self._names("data").items() if n.startswith("commit=") and n[7:] not in used
               and time.time() - t >= min_age_s]
        for n in old:
            self._fs.delete(self._at(f"data/{n}"), True)
        return sorted(n[7:] for n in old)
