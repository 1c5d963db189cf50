"""The free gate before any paid call, as one plan: screen by content, measure, drop duplicates, flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.leaders import greedy_leaders
from ..operators.numbering import numbered
from ..sources.files import quality_flags, screened
from ..sources.pixels import Decoder, measured, plain
from ..sources.tables import written

#: Bits in which the difference hashes of near duplicates differ at most.
NEAR_BITS = 5


def preflight(files: DataFrame, decode: Decoder = plain, dedupe: bool = True) -> DataFrame:
    """path, seq, doc_id, mime, sha256, width, height, megapixels, dhash, blur, brightness, truncated, reject_reason, duplicate_of, quality_flags and ok of each file.

    files: path, doc_id and content, as scan() gives them; paths are unique, and seq numbers them in
    their order, which decides which of two duplicates leads. Only live files have quality flags, but for that of a cut file.
    Contents are read in maps alone: what is shuffled and written is one narrow row per file.
    """
    seen = screened(files)
    heads = seen.select("path", "doc_id", "mime", "sha256", F.col("reject_reason").alias("_screened"))
    sizes = measured(seen.filter("reject_reason is null"), decode, key="path")
    return judged(heads.join(sizes, "path", "left"), dedupe)


def judged(rows: DataFrame, dedupe: bool = True) -> DataFrame:
    """preflight() from the measures on: path, doc_id, mime, sha256, _screened, error, width, height, dhash, blur, brightness, truncated."""
    rows = written(numbered(rows, "path"), "preflight")
    rejected = F.coalesce("_screened", "error")
    if dedupe:
        able = rows.filter(rejected.isNull()).select("seq", "sha256", F.col("dhash").alias("h"))
        found = greedy_leaders(able, NEAR_BITS).select("seq", F.col("reason").alias("_again"), F.col("duplicate_of").alias("_of"))
        names = rows.select(F.col("seq").alias("_of"), F.col("doc_id").alias("_lead"))
        rows = rows.join(found, "seq", "left").join(names, "_of", "left")
    else:
        rows = rows.withColumns({"_again": F.lit(None).cast("string"), "_lead": F.lit(None).cast("string")})
    reason = F.coalesce(rejected, F.col("_again"))
    megapixels = F.col("width") * F.col("height") / 1e6
    only_cut = F.array_compact(F.array(F.when(F.col("truncated"), "truncated_file_recovered")))
    flags = F.when(reason.isNull(), quality_flags(F.col("blur"), F.col("brightness"), megapixels, F.col("truncated"))).otherwise(only_cut)
    return rows.select(
        "path", "seq", "doc_id", "mime", "sha256", "width", "height", megapixels.alias("megapixels"), "dhash", "blur", "brightness", "truncated",
        reason.alias("reject_reason"),
        F.col("_lead").alias("duplicate_of"),
        flags.alias("quality_flags"),
        reason.isNull().alias("ok"),
    )
