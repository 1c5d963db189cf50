"""Quantiles by group: exact ones by counting, and mergeable sketches with a stated rank error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written

#: Bits that a round of counting settles: a group has at most 2 ** STEP counts in it.
STEP = 12
#: Size of a sketch; a quantile's rank is off by at most RANK_ERROR of all rows, with 99 per cent confidence.
SKETCH, RANK_ERROR = 1024, 0.004


def exact_quantiles(rows: DataFrame, by: list[str], value: Column, shares: list[float], scale: int = 1000) -> DataFrame:
    """by, share, n and quantile of the values of each group, interpolated between neighbours in order.

    Values are taken to 1 / scale. No group is sorted: a round counts the values by their next STEP bits
    above the least that is still possible and keeps the stretch in which the rank lies; after six rounds
    at most the value is known. A round reads the rows again and shuffles counts alone. Null values and groups are left out.
    """
    number = F.round(value * scale).cast("long")
    rows = written(rows.select(*by, number.alias("_x")).filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, "_x"]])), "values")
    ends = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("_x").alias("base"), F.max("_x").alias("top"))
    wide = lambda c: F.length(F.bin(c))
    place = lambda s: (F.col("n") - 1) * F.lit(float(s))
    targets = F.array(*[F.struct(F.lit(float(s)).alias("share"), r(place(s)).cast("long").alias("rank"), F.lit(up).alias("upper")) for s in shares for up, r in ((False, F.floor), (True, F.ceil))])
    state = ends.select(*by, "n", "base", (F.col("top") - F.col("base")).alias("span"), F.explode(targets).alias("t"))
    state = state.select(*by, "n", "base", "t.share", "t.rank", "t.upper", F.when(F.col("span") > 0, wide(F.col("span"))).otherwise(0).cast("int").alias("bits"))
    state = written(state, "ranks")
    key = [*by, "share", "upper"]
    while (state.agg(F.max("bits").alias("b")).first().b or 0) > 0:
        shift = F.greatest(F.col("bits") - STEP, F.lit(0))
        offset = F.col("_x") - F.col("base")
        inside = (offset >= 0) & (F.call_function("shiftright", offset, F.col("bits")) == 0)
        counts = rows.join(state, by).filter(inside).groupBy(*key, "n", "base", "rank", "bits", F.call_function("shiftright", offset, shift).alias("stretch")).agg(F.count("*").alias("m"))
        before = F.sum("m").over(Window.partitionBy(*key).orderBy("stretch")) - F.col("m")
        found = counts.withColumn("before", before).filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("m")))
        state = written(found.select(*by, "n", (F.col("base") + F.call_function("shiftleft", F.col("stretch"), shift)).alias("base"), "share", (F.col("rank") - F.col("before")).alias("rank"), "upper", shift.alias("bits")), "ranks")
    at = lambda up: F.max(F.when(F.col("upper") == up, F.col("base")))
    position = (F.col("n") - 1) * F.col("share")
    ends = state.groupBy(*by, "share", "n").agg(at(False).alias("lo"), at(True).alias("hi"))
    return ends.select(*by, "share", "n", ((F.col("lo") + (F.col("hi") - F.col("lo")) * (position - F.floor(position))) / scale).alias("quantile"))


def sketches(rows: DataFrame, by: list[str], value: Column) -> DataFrame:
    """by and sketch: what is kept of a day or a run, a few KB a group."""
    return rows.groupBy(*by).agg(F.kll_sketch_agg_double(value.cast("double"), F.lit(SKETCH)).alias("sketch"))


def merged(kept: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of several days or runs as one for each group of by."""
    return kept.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(kept: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """by, share, n and quantile (a value that occurs) of sketches with one row a group."""
    each = F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("quantile")) for s in shares]))
    return kept.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), each.alias("q")).select(*by, "q.share", "n", "q.quantile")
