"""Bitmaps as tables: sets of numbers that can be added up exactly, and filters of keys.

A set is rows of (cell, bits): cell numbers a stretch of 32768 numbers, bits says which of them are in it. Sets
of a day or a run are kept and united later; of a set, no row is larger than 4 KB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 32768
#: Bits of a filter of keys, and positions that a key has in it: 16 MB at most, however many keys.
FILTER_BITS, HASHES = 1 << 27, 2


def number_sets(rows: DataFrame, by: list[str], number_col: str) -> DataFrame:
    """by, cell and bits: the set of the numbers (long, nulls left out) of each group."""
    number = F.col(number_col).cast("long")
    cells = rows.filter(number.isNotNull()).select(*by, F.bitmap_bucket_number(number).alias("cell"), F.bitmap_bit_position(number).alias("_bit"))
    return cells.groupBy(*by, "cell").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def united(sets: DataFrame, by: list[str]) -> DataFrame:
    """by, cell and bits of the unions of sets over all that by leaves out."""
    return sets.groupBy(*by, "cell").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(sets: DataFrame, by: list[str]) -> DataFrame:
    """by and n, how many different numbers the sets of a group have together."""
    counted = united(sets, by).select(*by, F.bitmap_count("bits").alias("_n"))
    return counted.groupBy(*by).agg(F.sum("_n").alias("n")) if by else counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def _position(key: Column, k: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), key), F.lit(FILTER_BITS))


def _cell(position: Column) -> Column:
    return F.shiftright(position, CELL.bit_length() - 1)


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """cell and bits of a Bloom filter of a column: at most FILTER_BITS / CELL rows."""
    places = F.array(*[_position(F.col(key), k) for k in range(HASHES)])
    spots = keys.filter(F.col(key).isNotNull()).select(F.explode(places).alias("p"))
    cells = spots.select(_cell(F.col("p")).alias("cell"), (F.col("p") % CELL).alias("_bit"))
    return cells.groupBy("cell").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def may_be_in(rows: DataFrame, filter_: DataFrame, key: str, out_col: str = "maybe") -> DataFrame:
    """rows with out_col: false for keys that are surely not in the filter, and for nulls. The filter's size is bounded, so it is broadcast."""
    hit = F.col(key).isNotNull()
    for k in range(HASHES):
        position = _position(F.col(key), k)
        rows = rows.join(F.broadcast(filter_.select(F.col("cell").alias(f"_cell{k}"), F.col("bits").alias(f"_bits{k}"))), _cell(position) == F.col(f"_cell{k}"), "left")
        at = position % CELL
        byte = F.conv(F.hex(F.substring(F.col(f"_bits{k}"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = hit & F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    names = [c for c in rows.columns if not c.startswith(("_cell", "_bits"))]
    return rows.select(*names, hit.alias(out_col))

