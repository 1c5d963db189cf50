"""A dense number over a whole table without one sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written

#: Bits of monotonically_increasing_id() that count rows within a partition.
LOCAL_BITS = 33


def numbered(df: DataFrame, *order: str | Column, name: str = "seq", start: int = 0) -> DataFrame:
    """df with `name`: start, start + 1, ... in the given order, without gaps; rows that agree in it go in any order.

    Rows are range-partitioned and sorted within partitions, and written, so that a lost executor
    doesn't deal them anew. One row a partition, its count, comes to the driver; the running offsets
    go back by a broadcast of as many rows. Rows that agree in the whole order are dealt out too.
    Give it narrow rows: all columns of df are shuffled once.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "_tie"]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    table = written(dealt.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), "numbered")
    offsets, so_far = [], start
    for part, n in sorted((r["_part"], r["count"]) for r in table.groupBy("_part").count().collect()):
        offsets.append((part, so_far))
        so_far += n
    moved = spark.createDataFrame(offsets, "_part int, _before long")
    return table.join(F.broadcast(moved), "_part").select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))
