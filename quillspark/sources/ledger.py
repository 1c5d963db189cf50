"""The ledger of model calls: JSON lines, append only; gold labels; result files."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LEDGER = (
    "run string, doc_id string, stage string, model string, input_tokens bigint, output_tokens bigint, cache_write_tokens bigint, "
    "cache_read_tokens bigint, cost_usd double, latency_s double, image_px string, image_kb double, note string"
)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a ledger; of a missing file none. Blank lines and columns of no use are skipped."""
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").json(path).filter("doc_id is not null or stage is not null")


def append_ledger(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Append calls, latency to three places and kilobytes to one.

    With the name of a batch the rows are in the ledger once, however often a task, a job or a whole run
    is repeated: a batch has a folder of its own, what tasks wrote before is thrown away when they are
    repeated, and a batch that comes again replaces itself. Without a name each call appends.
    """
    rounded = rows.withColumns({"latency_s": F.round("latency_s", 3), "image_kb": F.round("image_kb", 1)})
    if batch is None:
        rounded.write.mode("append").json(path)
    else:
        rounded.write.mode("overwrite").json(f"{path}/batch={quote(batch, safe='')}")


def append_stream(calls: DataFrame, path: str, checkpoint: str, run: str):
    """A streaming query that appends calls (columns of LEDGER) as they come, each micro-batch once, also when it is restarted."""
    columns = [f.name for f in StructType.fromDDL(LEDGER).fields]

    def append(rows: DataFrame, number: int) -> None:
        append_ledger(rows.select(columns), path, f"{run}-{number}")

    return calls.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append)


def read_routing_gold(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, class, expect and duplicate_of from a document with a map under `labels`."""
    kind = "struct<labels:map<string,struct<class:string,expect:string,duplicate_of:string,note:string>>>"
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", kind)["labels"]).alias("doc_id", "g")).select("doc_id", "g.class", "g.expect", "g.duplicate_of")


def read_field_gold(spark: SparkSession, path: str) -> DataFrame:
    """doc_class, doc_id, field and want (JSON text); keys that start with an underscore are comments."""
    text = spark.read.text(path, wholetext=True)
    classes = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("doc_class", "docs")).filter(~F.col("doc_class").startswith("_") & F.col("docs").startswith("{"))
    docs = classes.select("doc_class", F.explode(F.from_json("docs", "map<string,string>")).alias("doc_id", "fields")).filter(F.col("fields").startswith("{"))
    return docs.select("doc_class", "doc_id", F.explode(F.from_json("fields", "map<string,string>")).alias("field", "want")).filter(~F.col("field").startswith("_"))


def write_results(envelopes: DataFrame, path: str) -> None:
    """Envelopes as JSON lines, in order of doc_id: files in order of their names, and lines within them."""
    envelopes.orderBy("doc_id").write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
