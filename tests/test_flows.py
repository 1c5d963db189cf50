import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import bitmaps, leaders, quantiles, rollups, scoring
from quillspark.operators.numbering import numbered
from quillspark.plans import runs
from quillspark.sources import cache, files, ledger
from quillspark.sources.store import Conflict, Store
from test_operators import greedy


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- numbers ----


def test_numbers_are_dense_and_in_order(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.randint(0, 5), k) for k in range(2000)] + [("a", 1, -1)] * 500
    df = spark.createDataFrame(rows, "g string, x int, k long").repartition(7)
    got = numbered(df, "g", F.col("x").desc(), "k", start=10)
    assert got.columns == ["g", "x", "k", "seq"] and "Window" not in plan(got)
    out = sorted(got.collect(), key=lambda r: r.seq)
    assert [r.seq for r in out] == list(range(10, 10 + len(rows)))
    assert [tuple(r)[:3] for r in out] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1], r[2]))
    assert numbered(df.limit(0), "g").collect() == []


def test_scan_with_numbers(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"f{k % 4}").mkdir(exist_ok=True)
        (tmp_path / f"f{k % 4}" / f"{k:02}.jpg").write_bytes(b"x%d" % k)
    (tmp_path / "f1" / "a.txt").write_bytes(b"no")
    rows = files.scan(spark, str(tmp_path), with_seq=True).collect()
    assert [r.seq for r in sorted(rows, key=lambda r: r.path)] == list(range(40)) and all(bytes(r.content) == b"x%d" % int(r.doc_id) for r in rows)
    some = files.scan(spark, str(tmp_path), limit=3, with_seq=True).select("seq", "doc_id").collect()
    assert sorted(map(tuple, some)) == [(0, "00"), (1, "04"), (2, "08")]


# ---- stores, caches, leaders ----


def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store", ["k"], "k long, v string", 4)


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "k long, v string")


def read(s):
    return sorted(tuple(r) for r in s.read().collect())


def test_store(spark, tmp_path):
    s = store(spark, tmp_path)
    assert read(s) == [] and s.version() == 0
    s.append(rows(spark, (1, "a"), (2, "b")), "one")
    s.append(rows(spark, (1, "c")), "two")
    s.append(rows(spark, (1, "c")), "two")
    assert read(s) == [(1, "a"), (1, "c"), (2, "b")] and s.version() == 2 and len(s.before("two")) == 1
    old = s.read()
    s.replace(rows(spark, (9, "z")), 2)
    assert read(s) == [(9, "z")] and old.count() == 3
    with pytest.raises(Conflict):
        s.replace(rows(spark, (8, "y")), 2)
    again = store(spark, tmp_path)
    assert read(again) == [(9, "z")]
    again.vacuum()
    assert read(again) == [(9, "z")] and len([p for p in (tmp_path / "store" / "data").iterdir() if p.name.startswith("seg=")]) == 1
    s.forget()
    assert read(store(spark, tmp_path)) == [(9, "z")]


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path)
    s.append(rows(spark, (1, "a")), "one")

    def die(*_):
        raise RuntimeError("lost")

    for write in (lambda: s.append(rows(spark, (2, "b")), "two"), lambda: s.replace(rows(spark, (3, "c")), 1)):
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(s, "_publish", die)
            write()
        assert read(s) == [(1, "a")]
    with pytest.raises(Exception, match="divi|DIVI"):
        s.append(rows(spark, (2, "b")).select("k", (F.lit(1) / (F.col("k") - 2)).cast("string").alias("v")), "three")
    assert read(s) == [(1, "a")]
    s.append(rows(spark, (2, "b")), "two")
    assert read(s) == [(1, "a"), (2, "b")]


def test_lookups_shuffle_files_alone(spark, tmp_path):
    envelopes = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.col("id").cast("string").alias("doc_id"), F.lit("extracted").alias("status"), F.lit(0.9).alias("confidence"), F.struct(F.lit(True).alias("passed")).alias("validation"), F.parse_json(F.lit('{"a": 1}')).alias("data"))
    c = cache.ResultCache(spark, f"file://{tmp_path}/cache", "f0", envelopes, 4)
    c.put(envelopes.filter("doc_id < 1000"))
    c.put(envelopes.filter("doc_id < 500"))
    c.put(envelopes.filter("doc_id >= 1900").withColumn("confidence", F.lit(0.1)))
    inbox = spark.range(900, 1100).select(F.concat(F.lit("x"), F.col("id")).alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for _ in range(2):
            hits, live = c.lookup(inbox)
            assert (hits.count(), live.count()) == (100, 100)
            assert json.loads(hits.first().data.toJson()) == {"a": 1} and hits.first().doc_id.startswith("x")
            # Of exchanges by key there is the files' alone; the other side is read as it lies.
            lines = plan(hits).splitlines()
            [at] = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(sha256" in line]
            assert "Range" in "".join(lines[at : at + 14]) and any("FileScan" in line and "filed" in line for line in lines[at:])
            c.compact()
        assert c.store.read().count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("seed", range(2))
def test_leaders_over_batches(spark, tmp_path, seed):
    rnd = random.Random(seed)
    seeds = [rnd.getrandbits(64) - 2**63 for _ in range(5)]
    rows = []
    for k in range(90):
        h = rnd.choice(seeds)
        for _ in range(rnd.choice([0, 0, 1, 3, 5, 7])):
            h ^= 1 << rnd.randrange(63)
        rows.append((k, rnd.choice([f"d{h}", f"d{h}x"]), h))
    index = leaders.LeaderIndex(spark, f"file://{tmp_path}/leaders", 5, buckets=4)
    got = []
    for k, (i, j) in enumerate(((0, 1), (1, 40), (40, 40), (40, 90))):
        batch = spark.createDataFrame(rows[i:j], "seq long, sha256 string, h long")
        found = [tuple(r) for r in index.add(batch, f"b{k}").collect()]
        # A repeated batch decides alike and adds nothing.
        n = index.store.read().count()
        assert sorted(tuple(r) for r in index.add(batch, f"b{k}").collect()) == sorted(found) and index.store.read().count() == n
        got += found
    assert sorted(got, key=lambda r: r[0]) == greedy(rows, 5)


def test_neighbours_are_never_broadcast(spark, tmp_path):
    # A thousand rows a hash of 8 bytes: were they broadcast by the size of the hashes, the driver would hold them all.
    hashes, known = f"{tmp_path}/hashes", f"{tmp_path}/known"
    spark.range(2000).select(F.xxhash64("id").alias("h")).write.parquet(hashes)
    of = spark.range(300).select(F.xxhash64("id").bitwiseXOR(F.lit(3)).alias("h"), F.col("id").alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    leaders.cells(of, 5).write.parquet(known)
    met = leaders.near_matches(spark.read.parquet(hashes), spark.read.parquet(known), 5)
    assert met.count() == 300 and met.select("seq").distinct().count() == 300
    met.collect()
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
    assert met.select(F.spark_partition_id()).distinct().count() > 1


# ---- the ledger ----

CALL = "run string, doc_id string, stage string, model string, input_tokens long, output_tokens long, cost_usd double, latency_s double, image_kb double"


def some_calls(spark, *ids):
    return spark.createDataFrame([("r", f"d{k}", "route", "m", 1, 2, 0.5, 0.25, 1.0) for k in ids], CALL)


def test_a_batch_is_in_the_ledger_once(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"

    @F.udf("string")
    def fails_at_the_end(doc):
        if doc == "d7":
            raise RuntimeError("task lost")
        return doc

    calls = some_calls(spark, *range(8)).repartition(4)
    with pytest.raises(Exception, match="task lost"):
        ledger.append_ledger(calls.withColumn("doc_id", fails_at_the_end("doc_id")), path, "a/1")
    assert ledger.read_ledger(spark, path).count() == 0
    for _ in range(2):
        ledger.append_ledger(calls, path, "a/1")
    ledger.append_ledger(some_calls(spark, 8, 9), path, "a/2")
    ledger.append_ledger(some_calls(spark, 10), path)
    assert sorted(r.doc_id for r in ledger.read_ledger(spark, path).collect()) == sorted(f"d{k}" for k in range(11))


def test_a_stream_that_is_restarted_appends_once(spark, tmp_path, monkeypatch):
    source, path, mark = tmp_path / "calls", f"file://{tmp_path}/ledger", f"file://{tmp_path}/mark"
    some_calls(spark, 1, 2).coalesce(1).write.json(str(source))
    stream = lambda: ledger.append_stream(spark.readStream.schema(ledger.LEDGER).json(str(source)), path, mark, "s").trigger(availableNow=True).start()
    real = ledger.append_ledger

    def dies_after(*args):
        real(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m, pytest.raises(Exception, match="driver lost"):
        m.setattr(ledger, "append_ledger", dies_after)
        stream().awaitTermination()
    stream().awaitTermination()
    some_calls(spark, 3).write.mode("append").json(str(source))
    stream().awaitTermination()
    assert sorted(r.doc_id for r in ledger.read_ledger(spark, path).collect()) == ["d1", "d2", "d3"]


# ---- sets, quantiles, counters ----


def test_sets_of_numbers(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.choice([rnd.randint(-70_000, 70_000), 5, 2**40, None])) for _ in range(3000)]
    sets = bitmaps.number_sets(spark.createDataFrame(rows, "g string, x long"), ["g"], "x")
    assert {r.g: r.n for r in bitmaps.sizes(sets, ["g"]).collect()} == {g: len({x for y, x in rows if y == g and x is not None}) for g in "ab"}
    assert bitmaps.sizes(sets, []).first().n == len({x for _, x in rows if x is not None})


def test_filter_of_keys(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    probe = spark.range(9000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("other")).unionByName(spark.createDataFrame([(None, 2)], "k string, other int"))
    got = bitmaps.may_be_in(probe, bitmaps.key_filter(keys, "k"), "k")
    assert got.columns == ["k", "other", "maybe"]
    found = {r.k for r in got.collect() if r.maybe}
    assert {str(k) for k in range(3000)} <= found and len(found) < 3010 and None not in found


def test_quantiles(spark):
    rnd = np.random.default_rng(3)
    values = {"a": rnd.integers(0, 3, 500) / 1000, "b": np.round(rnd.normal(0, 1e6, 2001), 3), "c": np.array([7.5]), "d": np.round(rnd.exponential(2, 1000), 3), "e": np.array([1.0, 2.0])}
    df = spark.createDataFrame([(g, float(x)) for g, v in values.items() for x in v] + [("a", None), (None, 1.0)], "g string, x double")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.share): (r.n, r.quantile) for r in quantiles.exact_quantiles(df, ["g"], F.col("x"), shares).collect()}
    assert set(got) == {(g, s) for g in values for s in shares}
    for (g, s), (n, x) in got.items():
        assert n == len(values[g]) and x == pytest.approx(np.quantile(values[g], s), abs=1e-6)
    kept = quantiles.sketches(df.filter("x is not null and g is not null").withColumn("part", F.col("x") > 0), ["g", "part"], F.col("x"))
    for r in quantiles.sketched_quantiles(quantiles.merged(kept, ["g"]), ["g"], [0.1, 0.5]).collect():
        v = np.sort(values[r.g])
        assert r.n == len(v) and (v < r.quantile).mean() - quantiles.RANK_ERROR - 1 / len(v) <= r.share <= (v <= r.quantile).mean() + quantiles.RANK_ERROR + 1 / len(v)


def test_counters_come_with_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(k, k % 3 == 0) for k in range(10)], "k int, ok boolean")
    assert rollups.screened_while_written(rows, f"{tmp_path}/files") == {"screened": 10, "passed": 4}
    assert spark.read.parquet(f"{tmp_path}/files").count() == 10
    gold = spark.createDataFrame([("a", "vendor_bill", "refuse", "z"), ("b", "vendor_bill", "extract", None), ("c", "vendor_bill", "refuse", None)], "doc_id string, class string, expect string, duplicate_of string")
    results = spark.createDataFrame([("a", "duplicate", "refused", None), ("b", "work_report", "extracted", "{}"), ("c", "vendor_bill", "extracted", '{"x": 1}')], "doc_id string, doc_class string, status string, raw string").withColumn("data", F.try_parse_json("raw")).drop("raw")
    counted = scoring.score_while_written(gold, results, f"{tmp_path}/verdicts")
    assert counted == scoring.score(gold, results).drop("routing_accuracy", "refusal_accuracy").first().asDict()
    assert sorted(map(tuple, scoring.listed(scoring.verdicts(gold, results)).collect())) == [("dedup_detected", "a"), ("hallucinated_docs", "c"), ("misrouted", "b")]


# ---- answers that repeat ----


def test_patches_are_tried_in_order(spark):
    from quillspark.operators.rules import validated

    rows = [("a", '{"reading_type": "odometer", "odometer_km": 512345, "trip_km": 10.2}'), ("b", '{"reading_type": "odometer", "odometer_km": 5}'), ("c", "{}")]
    env = spark.createDataFrame(rows, "doc_id string, raw string").select("doc_id", F.lit("meter_reading").alias("doc_class"), F.lit("extracted").alias("status"), F.parse_json("raw").alias("data"), F.lit(0.6).alias("confidence"))
    env = validated(env, "2024-03-10")
    told = [("a", 2, '{"odometer_km": 51234.5}'), ("a", 1, '{"odometer_km": 612345}'), ("a", 2, '{"odometer_km": 51234.5}'), ("a", 3, '{"odometer_km": 7.5}'), ("b", 1, '{"odometer_km": 9}'), ("c", 1, '{"odometer_km": 4000000}'), ("c", 2, '{"odometer_km": 40}')]
    patches = spark.createDataFrame(told, "doc_id string, at int, raw string").select("doc_id", "at", F.parse_json("raw").alias("patch"), F.array(F.lit("odometer_km")).alias("fields"))
    out = {r.doc_id: r for r in runs.reread(env, patches, "2024-03-10", order_col="at").collect()}
    got = {k: json.loads(r.data.toJson()).get("odometer_km") for k, r in out.items()}
    assert got == {"a": 51234.5, "b": 5, "c": 40} and len(out) == 3
    assert all(r.validation.passed for r in out.values()) and out["b"].confidence == 0.6
    assert runs.reread(env, patches.limit(0), "2024-03-10").count() == 3


def test_a_run_never_multiplies_files(spark):
    rows = [(k, "same", f"s{k}", None, None) for k in range(3)] + [(3, "same", "s0", "duplicate:exact", "same")]
    inbox = spark.createDataFrame(rows, "seq long, doc_id string, sha256 string, reject_reason string, duplicate_of string").withColumn("quality_flags", F.array().cast("array<string>"))
    said = [(k, stage, at, text) for k in range(3) for at in (1, 2, 2) for stage, text in (("route", '{"class": "meter_reading"}'), ("extract", json.dumps({"confidence": 0.9, "data": {"odometer_km": 100 * k + at}})))]
    responses = spark.createDataFrame(said, "seq long, stage string, at int, text string")
    out = runs.run_optimized(inbox, responses, "2024-03-10", key="seq", order_col="at")
    assert sorted((r.seq, r.doc_id, json.loads(r.data.toJson())["odometer_km"] if r.data else None) for r in out.collect()) == [(0, "same", 2), (1, "same", 102), (2, "same", 202), (3, "same", None)]
    by_name = responses.withColumn("doc_id", F.lit("same")).drop("seq")
    assert runs.run_optimized(inbox, by_name, "2024-03-10", order_col="at").count() == 4
    assert [r.seq for r in runs.ordered(out.withColumn("doc_id", F.col("seq").cast("string")), inbox.withColumn("doc_id", F.col("seq").cast("string")).withColumn("seq", -F.col("seq"))).collect()] == [3, 2, 1, 0]
