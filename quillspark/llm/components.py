"""Connected components: of many links by alternating large-star and small-star steps (Kiveris et al. 2014), of few in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, few


#: Links, of 16 bytes each, up to which one task joins them.
LOCAL_LINKS = 500_000


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    some = list(batches)
    a, b = (np.concatenate([x.column(c).to_numpy() for x in some] or [np.empty(0, dtype=np.int64)]) for c in ("a", "b"))
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    x, y, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    # Labels point at roots. Of each open link the larger root is hung below the smaller, then all point at roots again.
    while (apart := np.flatnonzero(label[x] != label[y])).size:
        x, y = x[apart], y[apart]
        p, q = label[x], label[y]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], names=["node", "root"])


def components(links: DataFrame, scratch: Scratch, name: str, rows: int | None = None, local: int = LOCAL_LINKS) -> DataFrame:
    """node and root, the least node it can reach, of every node of links(a, b) but the roots themselves; rows is a bound of the links.

    Each step is a minimum per node and a join, on distributed tables; only two numbers per round
    come to the driver, to see that nothing changed. Rounds follow the logarithm of the longest path.
    Up to LOCAL_LINKS links, counted first, are joined in one task.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = scratch.write(edges, f"{name}-0", rows=rows)
    seen, k = None, 0
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if k == 0 and mark.n <= local:
            return edges.coalesce(1).mapInArrow(_in_one_task, "node bigint, root bigint")
        if (mark.n, mark.s) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = (mark.n, mark.s)
        if not mark.n:
            continue
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(few(least, 2 * mark.n), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(few(down, 2 * mark.n), "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        k += 1
        # A step makes at most two edges of one.
        new = scratch.write(small, f"{name}-{k}", rows=2 * mark.n)
        scratch.drop(f"{name}-{k - 1}")
        edges = new
