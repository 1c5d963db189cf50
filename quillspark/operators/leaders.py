"""Exact and near duplicates in arrival order: greedy leaders.

A row is dropped if an earlier kept row has its bytes or a hash within `threshold` bits; rows that are
dropped never drop others. This differs from connected components: of a chain A, B, C with A near B
and B near C alone, C stays.

Candidates come from bands: of m bands, hashes that differ in at most t bits differ in at most t // m bits
of some band. One side goes to all values within that many bits of its own, the other to its own alone;
a few wide bands with neighbours leave far fewer chance meetings than t + 1 narrow ones. The order is resolved by a fixpoint: a row without earlier neighbours, or whose earlier neighbours are all
dropped, is kept; a row with a kept earlier neighbour is dropped.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashes import hamming
from ..sources.store import Store
from ..sources.tables import written


#: Neighbours of a band's value that one side is sent to at most.
MOST_NEIGHBOURS = 1000


def cuts_for(threshold: int, bits: int) -> list[int]:
    """Where bands begin and end: as few as keep the neighbours of a value within bounds."""
    for m in range(2, threshold + 3):
        width = -(-bits // m)
        if sum(comb(width, d) for d in range(threshold // m + 1)) <= MOST_NEIGHBOURS:
            break
    return [bits * k // m for k in range(m + 1)]


def _parts(h: Column, cuts: list[int]) -> list[Column]:
    return [F.shiftrightunsigned(h, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(cuts, cuts[1:])]


def _masks(width: int, most: int) -> Column:
    """All numbers of width bits with at most `most` set, as a literal."""
    return F.array(*[F.lit(sum(1 << b for b in some)).cast("long") for d in range(most + 1) for some in combinations(range(width), d)])


def _cell(band: int, part: Column) -> Column:
    return F.struct(F.lit(band).alias("band"), part.alias("bits"))


def cells(hashes: DataFrame, threshold: int, bits: int = 64) -> DataFrame:
    """The columns of hashes with band and bits: a row for each band of h."""
    cuts = cuts_for(threshold, bits)
    own = F.array(*[_cell(k, part) for k, part in enumerate(_parts(F.col("h"), cuts))])
    return hashes.select("*", F.explode(own).alias("_c")).select(*hashes.columns, "_c.band", "_c.bits")


def near_matches(hashes: DataFrame, others: DataFrame, threshold: int, bits: int = 64) -> DataFrame:
    """a (of hashes, column h without repeats) with the columns of others, cells(), at most threshold bits from it.

    Each pair is taken in the first band in which it is near, so no distinct is needed. Working on distinct
    hashes, a value shared by a third of all rows counts once.

    A hash becomes up to a thousand rows, which Spark's estimates of size don't see: the few hashes are dealt
    out before that, and both sides shuffled, whatever the session lets be broadcast.
    """
    cuts = cuts_for(threshold, bits)
    parts = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = threshold // (len(cuts) - 1)
    neighbours = lambda k, part: F.transform(_masks(cuts[k + 1] - cuts[k], near), lambda m: _cell(k, part.bitwiseXOR(m)))
    around = [neighbours(k, part) for k, part in enumerate(_parts(F.col("h"), cuts))]
    sent = hashes.repartition(parts, "h").select(F.col("h").alias("a"), F.explode(F.concat(*around)).alias("c")).select("a", "c.band", "c.bits")
    met = sent.join(others.hint("shuffle_hash"), ["band", "bits"]).filter(hamming(F.col("a"), F.col("h")) <= threshold)
    apart = _parts(F.col("a").bitwiseXOR(F.col("h")), cuts)
    first = F.coalesce(*[F.when(F.bit_count(part) <= near, F.lit(k)) for k, part in enumerate(apart)])
    return met.filter(F.col("band") == first).select("a", *[c for c in others.columns if c not in ("band", "bits")])


def near_pairs(hashes: DataFrame, threshold: int, bits: int = 64) -> DataFrame:
    """Pairs (a, b) of distinct hashes at most threshold bits apart, a < b. hashes has one column h, without repeats."""
    return near_matches(hashes, cells(hashes, threshold, bits), threshold, bits).filter("a < h").select("a", F.col("h").alias("b"))


def greedy_leaders(rows: DataFrame, threshold: int, key: str = "seq", digest: str = "sha256", hash_col: str = "h", bits: int = 64) -> DataFrame:
    """key, reason (null: kept; duplicate:exact; duplicate:near) and duplicate_of (the earliest kept neighbour) per row.

    Rows of one hash are decided together but for the first: the first row of a hash either leads
    or is near a leader; the others have that row, or what dropped it, before them. So the fixpoint
    runs over distinct hashes, ordered by their first row.
    """
    rows = written(rows.select(F.col(key).alias("seq"), F.col(digest).alias("digest"), F.col(hash_col).alias("h")), "leaders")
    firsts = written(rows.groupBy("h").agg(F.min("seq").alias("first")), "leaders")
    pairs = near_pairs(firsts.select("h"), threshold, bits)
    order = lambda name: firsts.select(F.col("h").alias(name), F.col("first").alias(f"{name}_first"))
    edges = pairs.join(order("a"), "a").join(order("b"), "b")
    earlier, later = F.col("a_first") < F.col("b_first"), F.col("a_first") > F.col("b_first")
    edges = edges.select(F.when(earlier, F.col("a")).otherwise(F.col("b")).alias("lo"), F.when(later, F.col("a")).otherwise(F.col("b")).alias("hi"))
    edges = written(edges, "leaders")
    # State of hashes with neighbours: null while open. Kept ones have no open or kept earlier neighbour.
    touched = edges.select("lo").union(edges.select("hi")).distinct().withColumnRenamed("lo", "h")
    state = written(touched.withColumn("kept", F.lit(None).cast("boolean")), "leaders")
    while True:
        seen = edges.join(state.select(F.col("h").alias("lo"), F.col("kept").alias("lo_kept")), "lo").groupBy(F.col("hi").alias("h")).agg(F.max(F.col("lo_kept").cast("int")).alias("some_kept"), F.count_if(F.col("lo_kept").isNull()).alias("n_open"))
        decided = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.coalesce("some_kept", F.lit(0)) == 1, False).when(F.coalesce("n_open", F.lit(0)) == 0, True)
        state = written(state.join(seen, "h", "left").select("h", decided.alias("kept")), "leaders")
        if not state.filter("kept is null").limit(1).count():
            break
    leaders = firsts.join(state, "h", "left").filter(F.coalesce("kept", F.lit(True))).select("h", "first")
    dropped = state.filter("not kept").select("h")
    # The earliest leader near a dropped hash.
    by = edges.join(leaders.select(F.col("h").alias("lo"), F.col("first").alias("lead")), "lo").join(dropped.withColumnRenamed("h", "hi"), "hi").groupBy(F.col("hi").alias("h")).agg(F.min("lead").alias("near"))
    heads = written(leaders.join(rows.select("seq", "digest").withColumnRenamed("seq", "first"), "first").select("h", "first", F.col("digest").alias("lead_digest")), "leaders")
    # A row with a leader's bytes is exact, whatever its place; equal bytes have equal hashes.
    # A later row of a leading hash is near that leader, or an even earlier one within the threshold.
    around = edges.join(leaders.select(F.col("h").alias("lo"), F.col("first").alias("lead")), "lo").groupBy(F.col("hi").alias("h")).agg(F.min("lead").alias("around"))
    out = rows.join(heads, "h", "left").join(by, "h", "left").join(around, "h", "left")
    exact = F.col("lead_digest").isNotNull() & (F.col("lead_digest") == F.col("digest")) & (F.col("seq") > F.col("first"))
    near = F.coalesce("near", F.least("first", "around"))
    lead = F.col("first").isNotNull() & (F.col("seq") == F.col("first"))
    return out.select(
        F.col("seq").alias(key),
        F.when(lead, F.lit(None)).when(exact, "duplicate:exact").otherwise("duplicate:near").alias("reason"),
        F.when(lead, F.lit(None)).when(exact, F.col("first")).otherwise(near).alias("duplicate_of"),
    )


def exact_duplicates(rows: DataFrame, key: str = "doc_id", digest: str = "sha256") -> DataFrame:
    """key and duplicate_of (the least key with the same bytes, null for that one itself) per row.

    A minimum per digest with map-side combine and a join, not a window: the rows of a frequent
    digest are never in one task.
    """
    first = rows.groupBy(digest).agg(F.min(key).alias("_first"))
    return rows.join(first, digest).select(key, F.when(F.col(key) != F.col("_first"), F.col("_first")).alias("duplicate_of"))


class LeaderIndex:
    """Leaders of earlier batches, kept by band, so that a new batch meets them without a second look at old rows.

    Batches come in order: all of a batch is later than the batches before it. Decisions on two
    batches are those on both at once. Repeating a batch under its name, after a failure too, gives the same
    decisions and adds nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: int, bits: int = 64, buckets: int = 64):
        self.threshold, self.bits = threshold, bits
        self.store = Store(spark, path, ["band", "bits"], "band int, bits long, h long, seq long, digest string", buckets)

    def add(self, rows: DataFrame, batch: str, key: str = "seq", digest: str = "sha256", hash_col: str = "h") -> DataFrame:
        """greedy_leaders() of a batch after those that came before it. key is a long."""
        rows = written(rows.select(F.col(key).cast("long").alias("seq"), F.col(digest).alias("digest"), F.col(hash_col).alias("h")), "batch")
        known = self.store.read(self.store.before(batch))
        hashes = rows.select("h").distinct()
        met = near_matches(hashes, known.withColumnRenamed("digest", "lead_digest").withColumnRenamed("seq", "lead"), self.threshold, self.bits)
        met = written(met.groupBy("a").agg(F.min("lead").alias("near"), F.max(F.when(F.col("a") == F.col("h"), F.struct("lead", "lead_digest"))).alias("own")), "met")
        # Whoever is near a kept leader leads nothing; the others settle it among themselves.
        old = rows.join(met, F.col("h") == F.col("a"))
        exact = F.coalesce(F.col("own.lead_digest") == F.col("digest"), F.lit(False))
        old = old.select("seq", F.when(exact, "duplicate:exact").otherwise("duplicate:near").alias("reason"), F.when(exact, F.col("own.lead")).otherwise(F.col("near")).alias("duplicate_of"))
        fresh = rows.join(met, F.col("h") == F.col("a"), "left_anti")
        found = written(old.unionByName(greedy_leaders(fresh, self.threshold, key="seq", digest="digest", hash_col="h", bits=self.bits)), "decided")
        leaders = rows.join(found.filter("reason is null").select("seq"), "seq")
        self.store.append(cells(leaders.select("h", "seq", "digest"), self.threshold, self.bits), batch)
        return found.withColumnRenamed("seq", key)
