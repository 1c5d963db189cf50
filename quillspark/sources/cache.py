"""Content-addressed cache of results: Parquet by fingerprint, latest by key."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.bitmaps import key_filter, may_be_in
from .store import Store

#: Confidence from which an extraction and a refusal are kept.
LEAST_EXTRACTED, LEAST_REFUSED = 0.80, 0.95


def fingerprint(material: dict) -> str:
    """16 hex digits over every choice that can change an answer; pass all of them: prompts, schemas, models, sizes."""
    return hashlib.sha256(json.dumps(material, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def cacheable(status: Column, confidence: Column, passed: Column) -> Column:
    """Valid extractions of enough confidence, and sure refusals."""
    return F.coalesce(((status == "extracted") & passed & (confidence >= LEAST_EXTRACTED)) | ((status == "refused") & (confidence >= LEAST_REFUSED)), F.lit(False))


def put(envelopes: DataFrame, path: str, print_: str) -> None:
    """Append what may be kept. Columns: sha256, doc_id, status, confidence, validation.passed, and the rest of the envelope."""
    kept = envelopes.filter(cacheable(F.col("status"), F.col("confidence"), F.col("validation.passed")))
    kept.withColumns({"fingerprint": F.lit(print_), "written": F.current_timestamp()}).write.mode("append").partitionBy("fingerprint").parquet(path)


def entries(spark: SparkSession, path: str, print_: str) -> DataFrame:
    """The latest entry of each key; only the folder of the fingerprint is read."""
    rows = spark.read.parquet(path).filter(F.col("fingerprint") == print_)
    order = Window.partitionBy("sha256").orderBy(F.col("written").desc(), F.col("doc_id"))
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "written", "fingerprint")


def lookup(files: DataFrame, cached: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(envelopes of files whose content is cached, under their own doc_id and at no cost; files that are not)."""
    known = cached.filter(cacheable(F.col("status"), F.col("confidence"), F.col("validation.passed")))
    hits = files.select("sha256", F.col("doc_id").alias("_doc")).join(known.drop("doc_id"), "sha256")
    hits = hits.withColumnRenamed("_doc", "doc_id")
    return hits, files.join(known.select("sha256"), "sha256", "left_anti")


class ResultCache:
    """The cache of one fingerprint as a bucketed table: lookups shuffle the files, never the cache.

    put() adds a segment; compact() leaves the latest entry of each key and switches to it in one step. A
    writer that dies in between leaves what was there readable.
    """

    def __init__(self, spark: SparkSession, path: str, print_: str, like: DataFrame, buckets: int = 64):
        """like: envelopes, of which the columns are taken; they have sha256, doc_id, status, confidence and validation.passed."""
        self.columns = like.columns
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        self.store = Store(spark, f"{path}/{print_}", ["sha256"], f"{fields}, written timestamp, filed long", buckets)

    def put(self, envelopes: DataFrame, segment: str | None = None) -> None:
        """Add what may be kept. A repeated job gives its segment's name and adds nothing twice."""
        kept = envelopes.filter(cacheable(F.col("status"), F.col("confidence"), F.col("validation.passed")))
        self.store.append(kept.withColumns({"written": F.current_timestamp(), "filed": F.lit(self.store.version() + 1).cast("long")}), segment)

    def entries(self) -> DataFrame:
        """The latest entry of each key; of entries of one put, that with the least doc_id. Without a shuffle, as the table lies by key."""
        order = Window.partitionBy("sha256").orderBy(F.col("filed").desc(), F.col("doc_id"))
        return self.store.read().withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")

    def compact(self) -> None:
        """Replace the table by its entries(). Raises Conflict where another writer was quicker; nothing is lost then."""
        version = self.store.version()
        self.store.replace(self.entries(), version)

    def lookup(self, files: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(envelopes of files whose content is cached, under their own doc_id and at no cost; files that are not).

        Files that a Bloom filter of the keys rules out never meet the cache.
        """
        entries = self.entries().drop("written", "filed")
        marked = may_be_in(files, key_filter(self.store.read().select("sha256"), "sha256"), "sha256", "_maybe")
        maybe = marked.filter("_maybe").drop("_maybe")
        hits = maybe.select("sha256", F.col("doc_id").alias("_doc")).join(entries.drop("doc_id"), "sha256").withColumnRenamed("_doc", "doc_id").select(self.columns)
        missed = maybe.join(entries.select("sha256"), "sha256", "left_anti")
        return hits, marked.filter("not _maybe").drop("_maybe").unionByName(missed)
