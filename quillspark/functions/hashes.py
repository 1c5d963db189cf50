"""Difference hashes, SimHash and Hamming distance on 64-bit integers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def difference_hash(values: Column, bits: int = 63) -> Column:
    """One bit for each neighbouring pair of an array, first pair highest: whether the left is the smaller."""
    return F.aggregate(
        F.sequence(F.lit(1), F.least(F.lit(bits), F.size(values) - 1)),
        F.lit(0).cast("long"),
        lambda acc, k: F.shiftleft(acc, 1).bitwiseOR((F.get(values, k - 1) < F.get(values, k)).cast("long")),
    )


def with_simhash60(rows: DataFrame, text: Column, keep: list[str], out: str = "h") -> DataFrame:
    """The columns `keep` of rows, narrow ones, with a 60-bit SimHash of the distinct blank-separated words: bit b is set where more word hashes have it than not.

    Word hashes are the first 15 hex digits of MD5, so that other engines can compute them too. The
    bits are counted by 60 sums over exploded words, in generated code; the rows of a text are in one
    task, so one row a text is shuffled. Rows alike in all are told apart.
    """
    words = F.filter(F.array_distinct(F.split(text, " ")), lambda w: w != "")
    own = rows.select(F.struct(*keep).alias("_row"), F.monotonically_increasing_id().alias("_id"), words.alias("_words"))
    cells = own.select("_row", "_id", F.explode_outer("_words").alias("w")).select("_row", "_id", F.conv(F.substring(F.md5("w"), 1, 15), 16, 10).cast("long").alias("c"))
    bit = lambda b: F.sum(F.shiftrightunsigned("c", b).bitwiseAND(F.lit(1).cast("long")))
    counts = cells.groupBy("_id").agg(F.first("_row").alias("_row"), F.count("c").alias("n"), *[bit(b).alias(f"b{b}") for b in range(60)])
    value = reduce(lambda acc, b: acc.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col("n"), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long"))), range(60), F.lit(0).cast("long"))
    return counts.select("_row.*", value.alias(out))
