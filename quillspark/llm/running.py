"""Running totals within groups, in an order, when one group may fill many partitions.

Rows are range-partitioned and sorted by group and order, so a group lies in neighbouring partitions.
Each task adds up its own rows; the driver takes one row a partition (its first and last group, and the
last one's totals) and works out what each partition's first group brings along from those before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import Scratch, tidied


def _sums(group: str, sums: list[str]):
    """Running count and sums of each batch, carried from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, carry = None, np.zeros(len(sums) + 1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(group).to_numpy()
            new = np.r_[True, keys[1:] != keys[:-1]]
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            out = []
            for k, values in enumerate([np.ones(len(keys), dtype=np.int64), *(batch.column(c).to_numpy().astype(np.int64) for c in sums)]):
                total = np.cumsum(values)
                total -= total[first] - values[first]
                if held is not None and keys[0] == held:
                    total[first == 0] += carry[k]
                out.append(total)
            held, carry = keys[-1], np.array([x[-1] for x in out])
            columns = [*batch.columns, *(pa.array(x) for x in out), pa.array(np.full(len(keys), part, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_n", *(f"_{c}" for c in sums), "_part"])

    return run


def running(df: DataFrame, group: str, order: list[Column], count: str, sums: dict[str, str], scratch: Scratch, name: str, parts: int) -> DataFrame:
    """df with `count`, the place of each row in its group, and the running totals named in sums (column: name).

    group is a long column without nulls. Rows that agree in the whole order go in any order.
    """
    cells = list(sums)
    kind = StructType([*df.schema.fields])
    for c in ["_n", *(f"_{c}" for c in cells)]:
        kind = kind.add(c, LongType())
    kind = kind.add("_part", IntegerType())
    tie = F.monotonically_increasing_id().alias("_tie")
    dealt = df.select("*", tie).repartitionByRange(parts, F.col(group), *order, F.col("_tie")).sortWithinPartitions(F.col(group), *order, F.col("_tie")).drop("_tie")
    table = scratch.write(dealt.mapInArrow(tidied(_sums(group, cells)), kind), name)
    totals = ["_n", *(f"_{c}" for c in cells)]
    last = F.max_by(F.struct(group, *totals), F.struct(group, "_n"))
    edges = table.groupBy("_part").agg(F.min(group).alias("first"), last.alias("last")).orderBy("_part").collect()  # one row a partition
    carried, held, carry = [], None, [0] * len(totals)
    for edge in edges:
        own = [edge["last"][t] for t in totals]
        if held is not None and held == edge["first"]:
            carried.append((edge["_part"], edge["first"], *carry))
            own = [a + b for a, b in zip(own, carry)] if edge["last"][group] == held else own
        held, carry = edge["last"][group], own
    names = [count, *(sums[c] for c in cells)]
    if not carried:
        return table.select(*df.columns, *(F.col(t).alias(n) for t, n in zip(totals, names)))
    moved = df.sparkSession.createDataFrame(carried, ", ".join(["_part int", "_first long", *(f"_add{t} long" for t in totals)]))
    table = table.join(F.broadcast(moved), "_part", "left")
    more = lambda t: F.when(F.col("_first") == F.col(group), F.col(f"_add{t}")).otherwise(F.lit(0))
    return table.select(*df.columns, *((F.col(t) + more(t)).alias(n) for t, n in zip(totals, names)))
