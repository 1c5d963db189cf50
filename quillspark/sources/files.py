"""Files: directory scan, type by content, and the free screening before any paid call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered

# Suffixes of the inbox; of these, batch requests leave out the first.
SUFFIXES = ["heic", "jpg", "jpeg", "png", "webp", "bmp", "gif"]
BATCH_SUFFIXES = SUFFIXES[1:]
LOW_SHARPNESS, DARK, FEW_MEGAPIXELS = 150.0, 90.0, 0.15


#: Files whose numbers are broadcast, of about 100 bytes each; beyond, contents are shuffled by path once.
FEW_FILES = 1_000_000


def scan(spark: SparkSession, path: str, limit: int = 0, suffixes: list[str] | None = None, with_seq: bool = False) -> DataFrame:
    """doc_id (file stem), path, length and content of the files with a known suffix, the first `limit` by path (0: all).

    with_seq adds seq, the place of a file among these by path, from 0 and without gaps. Names alone
    are sorted for it, in range partitions; no content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    known = "|".join(suffixes or SUFFIXES)
    files = files.filter(F.lower("path").rlike(f"\\.({known})$"))
    if limit:
        files = files.orderBy("path").limit(limit)
    doc_id = F.regexp_extract("path", "([^/]*)\\.[^./]*$", 1).alias("doc_id")
    if not with_seq:
        return files.select(doc_id, "path", "length", "content")
    names = numbered(files.select("path"), "path")
    names = F.broadcast(names) if names.count() <= FEW_FILES else names
    return files.join(names, "path").select(doc_id, "path", "seq", "length", "content")


def sniff(content: Column) -> Column:
    """MIME type by the first bytes; null where none is known."""
    head = F.substring(content, 1, 32)
    is_at = lambda start, hexed: F.substring(head, start, len(hexed) // 2) == F.unhex(F.lit(hexed))
    brand = F.substring(head, 9, 4)
    heic = is_at(5, "66747970") & brand.isin(*[bytearray(b) for b in (b"heic", b"heix", b"mif1", b"hevc")])
    return (
        F.when(is_at(1, "FFD8FF"), "image/jpeg")
        .when(is_at(1, "89504E470D0A1A0A"), "image/png")
        .when(is_at(1, "474946383761") | is_at(1, "474946383961"), "image/gif")
        .when(is_at(1, "424D"), "image/bmp")
        .when(heic, "image/heic")
        .when(is_at(1, "52494646") & is_at(9, "57454250"), "image/webp")
    )


def screened(files: DataFrame, content_col: str = "content") -> DataFrame:
    """files with mime, sha256 and reject_reason (null: may go on).

    Only the head and the hash of the content are looked at, so no content crosses a shuffle.
    """
    mime = sniff(F.col(content_col))
    head = F.lower(F.decode(F.substring(F.col(content_col), 1, 64), "ISO-8859-1"))
    html = head.contains("<!doctype") | head.contains("<html")
    reason = F.when(mime.isNull(), F.concat(F.lit("not_an_image:"), F.when(html, "html_error_page").otherwise("unrecognised_format"))).when(mime == "image/heic", "unsupported_format:heic_needs_transcode")
    return files.withColumns({"mime": mime, "sha256": F.sha2(F.col(content_col), 256), "reject_reason": reason})


def quality_flags(blur: Column, brightness: Column, megapixels: Column, truncated: Column) -> Column:
    """Annotations in the order they are made; none of them rejects."""
    return F.array_compact(
        F.array(
            F.when(truncated, "truncated_file_recovered"),
            F.when(blur < LOW_SHARPNESS, "low_sharpness"),
            F.when(brightness < DARK, "underexposed"),
            F.when(megapixels < FEW_MEGAPIXELS, "very_low_resolution"),
        )
    )


def rejected_class(reason: Column) -> Column:
    """The class of a rejected file: whatever is no image is no document, all else is filed as a duplicate."""
    return F.when(reason.startswith("not_an_image"), "not_a_document").otherwise("duplicate")
