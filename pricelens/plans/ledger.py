"""A ledger of the steps of a run, so that a run that failed goes on where it
stopped, and a changed input restarts the steps behind it and no others.

Every step has one small JSON file: the version of what it was built from, the
rows it wrote, and whether it ended.  A version is a digest of the step's name,
its parameters and the versions of its inputs, so a change anywhere upstream
changes all versions behind it.  A step is marked open before its table is
touched; a step that died half-way is therefore done again whatever inputs come
next, and a table never passes for one built from other inputs.  The files are
replaced in one step each (a rename that replaces, as on HDFS and POSIX).

One run at a time writes to a ledger.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Step:
    """A step writes one ``table`` from the steps and outside inputs it follows."""

    name: str
    table: str
    after: tuple[str, ...]
    run: Callable[[], int]
    parameters: str = ""


def content_version(df: DataFrame) -> str:
    """Digest of the rows of an outside input, whatever their order and
    partitions: one scan, two sums of 64-bit row hashes and a count."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")) for seed in (1, 2)]
    row = df.agg(F.count(F.lit(1)), *sums).first()
    return hashlib.sha256(json.dumps([df.schema.json(), *map(str, row)]).encode()).hexdigest()


class StepLedger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def entry(self, step: str) -> dict | None:
        at = self._at(f"{step}.json")
        fs = at.getFileSystem(self._conf)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, step: str, entry: dict) -> None:
        final, draft = self._at(f"{step}.json"), self._at(f".{uuid.uuid4().hex}")
        fs = final.getFileSystem(self._conf)
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        rename = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        files.rename(fs.makeQualified(draft), fs.makeQualified(final), options)

    def run(self, steps: list[Step], inputs: dict[str, str]) -> dict[str, int]:
        """Run the steps in their order, but those that are done from the same
        inputs and whose table is there.  ``inputs``: versions of the outside
        inputs.  Returns the rows of every step's table, run now or before."""
        versions, rows = dict(inputs), {}
        for step in steps:
            made = json.dumps([step.name, step.parameters, *(versions[a] for a in step.after)])
            version = versions[step.name] = hashlib.sha256(made.encode()).hexdigest()
            old = self.entry(step.name)
            if old and old["done"] and old["version"] == version and self.spark.catalog.tableExists(step.table):
                rows[step.name] = old["rows"]
                continue
            self._put(step.name, {"version": version, "done": False, "rows": None})
            rows[step.name] = step.run()
            self._put(step.name, {"version": version, "done": True, "rows": rows[step.name]})
        return rows
