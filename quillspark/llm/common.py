"""What the operators of this subpackage share: the shared folder, written tables, bucket counts."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts of the operators define it; everything else is part of a word.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a local master may go without; it then gets a folder of its own, once per session.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="quillspark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


#: Narrow rows of a written table that are worth a task of their own.
ROWS_A_FILE = 100_000


#: Tables that have not been dropped yet.
_OPEN: list[Scratch] = []


@contextlib.contextmanager
def dropped_after() -> Iterator[None]:
    """Drop whatever tables were begun inside, once what is made of them has been written."""
    begun = len(_OPEN)
    yield
    for scratch in _OPEN[begun:]:
        scratch.drop()
    del _OPEN[begun:]


class Scratch:
    """Written tables of one run of an operator, in a folder of their own in the shared folder.

    A written table cuts lineage and survives the loss of executors. drop() removes what is no
    longer needed; what is left goes when the driver's interpreter ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.tables: list[str] = []
        _OPEN.append(self)
        atexit.register(self._end)

    def write(self, df: DataFrame, name: str, buckets: tuple[int, str] | None = None, rows: int | None = None) -> DataFrame:
        """df, computed once and read back. Of a table of few `rows` (an upper bound) the tasks and files are few."""
        if rows is not None:
            df = df.coalesce(max(1, min(df.sparkSession.sparkContext.defaultParallelism * 100, -(-rows // ROWS_A_FILE))))
        to = f"{self.path}/{name}"
        writer = df.write.option("compression", "zstd").mode("error")
        if buckets is None:
            writer.parquet(to)
            return self.spark.read.schema(df.schema).parquet(to)
        table = f"q_{name}_{uuid.uuid4().hex}"
        writer.bucketBy(*buckets).option("path", to).format("parquet").saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def size(self, name: str) -> int:
        """Bytes of a written table; only the file system is asked."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def drop(self, name: str | None = None) -> None:
        for table in [t for t in self.tables if name is None or t.startswith(f"q_{name}_")]:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.tables.remove(table)
        to = self.path if name is None else f"{self.path}/{name}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(to)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _end(self) -> None:
        with contextlib.suppress(Exception):
            self.drop()


#: Rows of two or three numbers up to which one side of a join is broadcast, about 30 MB.
FEW_ROWS = 1_000_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """df, to be broadcast if it has at most `rows` narrow rows and these are few: no key of the other side is hot then.

    Beyond, the join is dealt by key, and adaptive execution splits a hot one.
    """
    return F.broadcast(df) if rows <= FEW_ROWS else df


def parts_for(spark: SparkSession, size: int, bytes_each: int = 24 << 20) -> int:
    """Into how many parts to deal `size` bytes: the session's shuffle partitions, or more so that a part stays small."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bytes_each))


def words_of(text: Column) -> Column:
    """Words of ASCII-blank separated text, as an array; empty for null and blank texts."""
    none = F.array().cast("array<string>")
    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), lambda bare: F.when(bare == "", none).otherwise(F.split(bare, SPACE_RUN)))


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body names it.

    Lambda variables hold a value; a plain alias could be copied into each use by the optimiser.
    """
    return F.transform(F.array(value), body)[0]


def tidy() -> None:
    """Give memory that a task has freed back to the system; a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run):
    """A map over Arrow batches that tidies up after its task."""

    def map_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            tidy()

    return map_


def by_size(batch: pa.RecordBatch, size: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Slices of batch that hold about size bytes of texts each, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
