"""Write, audit, publish: a partitioned table whose readable state is a manifest.

A load writes its partitions beside the published ones, under a version of
their own. Checks then run on what was written; only if they pass does a new
manifest name the new versions. Readers list exactly the folders the manifest
names, so a load that fails or is stopped leaves the last state readable, and
a rerun starts over. The manifest also holds the rows of each partition:
whether a period is there, and complete, is answered without reading data.

One load at a time writes to a table (as a scheduler runs a chain).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
VERSION = "_version"
Check = Callable[[DataFrame], bool]


class MissingPeriodError(RuntimeError):
    pass


class AuditError(RuntimeError):
    pass


def folder_value(value: object) -> str:
    """A partition value as its folder says it."""
    if value is None:
        return NO_VALUE
    return value.isoformat() if isinstance(value, dt.date) else str(value)


@dataclass(frozen=True)
class Staged:
    version: str
    schema: T.StructType
    rows: Mapping[str, int]


class PublishedTable:
    def __init__(self, spark: SparkSession, root: str, partition: str):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition

    # ---- files --------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        fs, at = self._fs(), self._path("manifest")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _data_path(self, value: str, version: str) -> str:
        return f"{self.root}/data/{self.partition}={value}/{VERSION}={version}"

    # ---- manifest -----------------------------------------------------------

    def manifest(self) -> dict:
        """The newest state: ``partitions`` (value -> version and rows),
        ``schema`` and the ``token`` of the load that published it."""
        numbers = self._manifests()
        if not numbers:
            return {"partitions": {}, "schema": None, "token": None}
        stream = self._fs().open(self._path(f"manifest/{numbers[-1]:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def partitions(self) -> dict[str, int]:
        """Published partitions and their rows."""
        return {v: p["rows"] for v, p in self.manifest()["partitions"].items()}

    def require(self, value: object) -> None:
        """Refuse to go on unless the partition is published (no job is run)."""
        if folder_value(value) not in self.manifest()["partitions"]:
            raise MissingPeriodError(f"{self.partition}={folder_value(value)} is not published; run it first")

    # ---- load ---------------------------------------------------------------

    def stage(self, df: DataFrame, values: Iterable[object] | None = None) -> Staged:
        """Write the partitions of ``df`` as a version that nobody reads yet.
        ``values`` names partitions the load answers for; one without rows will
        be published as empty."""
        version = uuid.uuid4().hex[:12]
        (df.hint("rebalance", self.partition).withColumn(VERSION, F.lit(version)).write.mode("append")
           .partitionBy(self.partition, VERSION).parquet(f"{self.root}/data"))
        staged = Staged(version, df.schema, {})
        found = {folder_value(v): 0 for v in values or ()}
        fs, at = self._fs(), self._path("data")
        for folder in fs.listStatus(at):
            value = folder.getPath().getName().split("=", 1)[-1]
            if fs.exists(self._path(f"data/{folder.getPath().getName()}/{VERSION}={version}")):
                found[value] = 0
        held = {v: {"version": version} for v in found}
        counts = self._frame(held, df.schema).groupBy(self.partition).count().collect()
        found.update({folder_value(r[0]): r["count"] for r in counts})
        return Staged(staged.version, staged.schema, found)

    def staged(self, staged: Staged) -> DataFrame:
        return self._frame({v: {"version": staged.version} for v, n in staged.rows.items() if n}, staged.schema)

    def audit(self, staged: Staged, checks: Mapping[str, Check]) -> None:
        rows = self.staged(staged)
        failed = [name for name, check in checks.items() if not check(rows)]
        if failed:
            raise AuditError(f"version {staged.version} is not published: {', '.join(failed)}")

    def publish(self, staged: Staged, token: int | str | None = None) -> None:
        """Name the staged partitions in a new manifest, all at once."""
        now, numbers = self.manifest(), self._manifests()
        now["partitions"].update({v: {"version": staged.version, "rows": n} for v, n in staged.rows.items()})
        now.update(schema=staged.schema.jsonValue(), token=token)
        number = numbers[-1] + 1 if numbers else 0
        fs, temporary = self._fs(), self._path(f"manifest/.{number}-{uuid.uuid4().hex[:8]}")
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps(now).encode()))
        out.close()
        if not fs.rename(temporary, self._path(f"manifest/{number:012d}.json")):
            raise RuntimeError(f"manifest {number} of {self.root} was published by another load")

    def load(self, df: DataFrame, values: Iterable[object] | None = None, checks: Mapping[str, Check] | None = None,
             token: int | str | None = None) -> None:
        """Stage, audit and publish."""
        staged = self.stage(df, values)
        self.audit(staged, checks or {})
        self.publish(staged, token)

    # ---- read ---------------------------------------------------------------

    def _frame(self, held: Mapping[str, dict], schema: T.StructType) -> DataFrame:
        fs = self._fs()
        paths = [self._data_path(v, p["version"]) for v, p in held.items()]
        paths = [p for p in paths if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        kinds = T.StructType([f for f in schema.fields] + [T.StructField(VERSION, T.StringType())])
        return (self.spark.read.schema(kinds).option("basePath", f"{self.root}/data").parquet(*paths)
                .select(*schema.names))

    def read(self, values: Iterable[object] | None = None) -> DataFrame:
        """The published rows, of some partitions if ``values`` names them."""
        now = self.manifest()
        if now["schema"] is None:
            raise MissingPeriodError(f"nothing is published in {self.root}")
        wanted = None if values is None else {folder_value(v) for v in values}
        held = {v: p for v, p in now["partitions"].items() if p.get("rows") and (wanted is None or v in wanted)}
        return self._frame(held, T.StructType.fromJson(now["schema"]))


def previous(prev: DataFrame | PublishedTable, period: str, day: str) -> DataFrame:
    """The snapshot of the day before ``day``. A published chain without that
    day is refused, so a missed day cannot drop the history before it; a plain
    DataFrame is the caller's word that it holds the day before."""
    before = dt.date.fromisoformat(day) - dt.timedelta(days=1)
    if isinstance(prev, PublishedTable):
        prev.require(before)
        prev = prev.read([before])
    return prev.filter(F.col(period) == F.lit(before.isoformat()).cast("date"))


def one_row_per(*keys: str) -> Check:
    """Audit: no key stands twice."""
    return lambda df: df.groupBy(*keys).count().filter("count > 1").isEmpty()
