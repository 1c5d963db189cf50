"""Shards that all hold the corpus's mixture of sources: proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source, and a row's fractional rank is its place there,
moved by a seeded phase of the source below one row, over the source's count. The phases keep sources
of equal size from arriving in bunches. Sorted by fractional rank, every run of rows holds sources in proportion, so
cutting the order into equal runs gives shards with the mixture. Both orders come from counts per
hash bucket and ranks within buckets, so no task sorts a whole source and no source, however large,
meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Rows of a bucket, about; and the most buckets, which bounds the running sums over them.
BUCKET_ROWS, MOST_BUCKETS = 1024, 1 << 16


def _hash60(seed: int, *cols) -> F.Column:
    """60 bits of MD5, which other engines compute as well."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def stratified_shards(docs: DataFrame, shards: int = 24, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row; law is `rows`.

    Shard sizes differ by one row at most. Of K sources, one with a share p of all rows has less than
    1 + p * (K + 1) rows more or less than its share in any shard: up to any place in the order each
    source is less than one row off its share, and a cut moves by what all sources are off together.
    With phases that are not in step this is about the root of K, not K. The assignment depends on ids,
    texts' checksums and the seed alone. A null source is a source of its own; a
    null text has size 8 and the checksum of the empty text. Null ids, repeated ids and repeated rows
    keep a slot each; those alike in every column used are interchangeable. An empty table gives no
    rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shard")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = scratch.write(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("stratum"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            _hash60(seed, F.col(id_col), F.crc32(text.cast("binary"))).alias("h"),
        ),
        "rows",
    )
    n = rows.count()
    k = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.floor(F.col("h") / F.lit(float(1 << 60)) * k).cast("int"))

    # Place within the source: rows of earlier buckets, then rows before it in its bucket.
    order = ["h", "doc_id", "text_crc32", "size"]
    per = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("stratum")
    per = per.select(
        "stratum",
        "bucket",
        F.coalesce(F.sum("n").over(whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
        (_hash60(seed, F.col("stratum")) / F.lit(float(1 << 60))).alias("phase"),
    )
    placed = (
        rows.withColumn("row", F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy(*order)))
        .join(per, ["stratum", "bucket"])
        .withColumn("part", ((F.col("before") + F.col("row") - 1).cast("double") + F.col("phase")) / F.col("total").cast("double"))
        .withColumn("slice", F.floor(F.col("part") * k).cast("int"))
    )

    # Place in the interleaved order, in the same way. At most MOST_BUCKETS sums meet in one task.
    placed = scratch.write(placed.drop("bucket", "row", "before", "total", "phase"), "placed")
    cuts = placed.groupBy("slice").agg(F.count("*").alias("n"))
    cuts = cuts.select("slice", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    final = placed.withColumn("row", F.row_number().over(Window.partitionBy("slice").orderBy("part", "stratum", *order))).join(cuts, "slice")

    base, more = divmod(n, shards)
    place = F.col("before") + F.col("row") - 1
    shard = F.when(F.col("place") < more * (base + 1), F.expr(f"place div {base + 1}")).otherwise(more + F.expr(f"(place - {more * (base + 1)}) div {max(1, base)}"))
    start = F.col("shard") * base + F.least(F.col("shard"), F.lit(more))
    return final.withColumn("place", place).withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("place") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
