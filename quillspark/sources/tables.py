"""Written tables between the steps of iterative operators, in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local master without one gets a folder of its own."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="quillspark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which goes when the driver ends."""
    to = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, to)
    return to


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once and read from Parquet: lineage is cut, and lost executors lose nothing. The table goes when the driver ends."""
    spark = df.sparkSession
    to = scratch_path(spark, name)
    df.write.parquet(to)
    return spark.read.schema(df.schema).parquet(to)
