"""A keyed table that grows by segments: bucketed by its keys, with a log that says which segments count.

Segments are partitions of one bucketed Parquet table, so a join by the keys shuffles the other side
alone. A segment counts from the moment the log names it: one file per version, written beside its
place and renamed, which fails if another writer was first. What a writer leaves that dies before is
never read.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has published this version."""


class Store:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str, buckets: int):
        """path lies in a folder that driver and executors share; keys, schema and buckets are those of its first use."""
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.columns = spark.createDataFrame([], schema).columns
        self.table = "store_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({schema}, seg string) USING parquet PARTITIONED BY (seg) CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{self.path}/data'")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The latest version that was published; 0 before the first."""
        log, fs = self._fs(f"{self.path}/_log")
        names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
        return max((int(n) for n in names if n.isdigit()), default=0)

    def segments(self, version: int | None = None) -> list[str]:
        """The segments of a version, in the order in which they came."""
        version = self.version() if version is None else version
        return [r.value for r in self.spark.read.text(f"{self.path}/_log/{version:010}").collect()] if version else []

    def _publish(self, version: int, segments: list[str]) -> None:
        jvm = self.spark._jvm
        to, fs = self._fs(f"{self.path}/_log/{version:010}")
        aside, _ = self._fs(f"{self.path}/_log/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray("\n".join(segments).encode()))
        out.close()
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri()).rename(aside, to, plain)
        except Exception as e:
            fs.delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} of {self.path}") from e
            raise

    def _written(self, df: DataFrame, segment: str) -> None:
        rows = df.select(*self.columns, F.lit(segment).alias("seg")).repartition(self.buckets, *self.keys)
        rows.write.mode("append").insertInto(self.table)

    def append(self, df: DataFrame, segment: str | None = None) -> None:
        """Add the rows of df. A segment that counts already is not added again: a job may be repeated under its name."""
        segment = segment or uuid.uuid4().hex
        own = f"{segment}.{uuid.uuid4().hex}"
        self._written(df, own)
        while True:
            version = self.version()
            now = self.segments(version)
            if segment in [s.partition(".")[0] for s in now]:
                return
            try:
                return self._publish(version + 1, [*now, own])
            except Conflict:
                continue

    def replace(self, df: DataFrame, of: int) -> None:
        """Publish df as all of the table, if version `of` still is the latest; else Conflict."""
        own = f"{uuid.uuid4().hex}.all"
        self._written(df, own)
        self._publish(of + 1, [own])

    def before(self, segment: str) -> list[str]:
        """What counted before a segment came; all that counts if it didn't."""
        now = self.segments()
        names = [s.partition(".")[0] for s in now]
        return now[: names.index(segment)] if segment in names else now

    def read(self, segments: list[str] | None = None) -> DataFrame:
        """The rows of the segments, those of the latest version by default; later versions don't change it."""
        segments = self.segments() if segments is None else segments
        # Segments that other sessions wrote are new to this one's catalog.
        if segments:
            self.spark.catalog.recoverPartitions(self.table)
        return self.spark.table(self.table).filter(F.col("seg").isin(segments)).drop("seg")

    def vacuum(self) -> None:
        """Delete segments that the latest version doesn't name; readers of older versions must be done."""
        now = set(self.segments())
        data, fs = self._fs(f"{self.path}/data")
        for status in fs.listStatus(data) if fs.exists(data) else []:
            name = status.getPath().getName()
            if name.startswith("seg=") and name.removeprefix("seg=") not in now:
                fs.delete(status.getPath(), True)

    def forget(self) -> None:
        """Take the table out of the session's catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
