from pyspark.sql import functions as F

from quillspark.streaming import ingest


def drained(stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_first_seen(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00", "x"), ("b", "2024-01-01 01:00:00", "x"), ("c", "2024-01-01 02:00:00", "y")]
    df = spark.createDataFrame(rows, "doc_id string, t string, content string").withColumn("modificationTime", F.to_timestamp("t")).drop("t")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    drained(ingest.first_seen(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")), "seen")
    assert sorted(r.content for r in spark.table("seen").collect()) == ["x", "y"]


def test_spend(spark, tmp_path):
    rows = [("route", f"2024-01-01 0{h}:10:00", 10, 1, 0.5) for h in (0, 0, 1, 6)]
    df = spark.createDataFrame(rows, "stage string, t string, input_tokens long, output_tokens long, cost_usd double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.coalesce(1).write.parquet(f"{tmp_path}/calls")
    drained(ingest.spend(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/calls")), "spend")
    assert sorted(r.calls for r in spark.table("spend").collect()) == [1, 2]
