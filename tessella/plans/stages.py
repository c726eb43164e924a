"""Long workflows in stages that are written down, so that a run after a lost driver goes on where the last one ended."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "key STRING, stage STRING, path STRING, rows BIGINT, digest STRING"


def digest(df: DataFrame) -> str:
    """The number of rows and a sum of their hashes: the same for the same rows in any order."""
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{r[0]}:{r[1]}"


def settings(thing) -> str:
    """The name and settings of an object that isn't fitted yet, in the order of their names."""
    if hasattr(thing, "__dict__"):
        return f"{type(thing).__name__}({', '.join(f'{k}={settings(v)}' for k, v in sorted(vars(thing).items()))})"
    if isinstance(thing, dict):
        return "{" + ", ".join(f"{k!r}: {settings(v)}" for k, v in sorted(thing.items(), key=repr)) + "}"
    if isinstance(thing, (list, tuple)):
        return "[" + ", ".join(map(settings, thing)) + "]"
    return repr(thing)


class Manifest:
    """A folder of stage tables and a list of those that are whole.

    A stage is known by its name, its settings and the digests of its inputs; it is listed only after its table is
    written, with the table's rows and digest. What a broken run left half written is never listed and never read.
    The folder must be one that all executors reach and that outlives the driver.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.made: list[str] = []  # stages that this run has computed
        listed = spark.read.schema(ROW).json(f"{folder}/_manifest").collect() if self._exists(f"{folder}/_manifest") else []
        self.done = {r["key"]: r for r in listed}  # a row for each stage

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _exists(self, path: str) -> bool:
        fs, at = self._fs(path)
        return fs.exists(at)

    def table(self, stage: str, inputs: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of ``stage``, computed by ``make`` unless it is listed for the same ``inputs``."""
        key = hashlib.sha256(f"{stage}|{inputs}".encode()).hexdigest()
        if key not in self.done:
            path = f"{self.folder}/{key[:16]}-{uuid.uuid4().hex}"
            make().write.parquet(path)
            found = digest(self.spark.read.parquet(path))
            row = (key, stage, path, int(found.split(":")[0]), found)
            rows = self.spark.createDataFrame([row], ROW)
            rows.coalesce(1).write.mode("append").json(f"{self.folder}/_manifest")
            self.done[key] = rows.first()
            self.made.append(stage)
        return self.spark.read.parquet(self.done[key]["path"])

    def digest_of(self, stage: str, inputs: str) -> str:
        return self.done[hashlib.sha256(f"{stage}|{inputs}".encode()).hexdigest()]["digest"]

    def remove(self) -> None:
        """Deletes the folder, once the workflow's results are elsewhere."""
        fs, at = self._fs(self.folder)
        fs.delete(at, True)
        self.done = {}
