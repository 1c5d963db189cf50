"""Queries over whole flows: numbering, screening, batches, the cache and the ledger over several writes, re-reads, runs with repeated answers.

Stand-ins are those of queries.py: documents are files, events are calls, orders are bills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.hashes import with_simhash60
from .operators import bitmaps, leaders, quantiles, rollups, rules, scoring
from .operators.numbering import numbered
from .plans import classes, runs
from .plans.preflight import judged
from .queries import CALLS_SQL, SIMHASH_SQL, VERDICT_SQL, _judged, calls, table
from .rule_queries import ORACLES, QUERIES, query
from .sources import ledger
from .sources.cache import ResultCache
from .sources.tables import scratch_path, written

__all__ = ["ORACLES", "QUERIES"]

AS_OF = "2024-01-15"

# ---- W1, W6: a number over the scan ----

PATH_SQL = "lang || '/' || source || '/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.jpg'"


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat("lang", F.lit("/"), "source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".jpg"))
    return table(spark, sf_dir, "documents").withColumn("path", path)


@query(f"SELECT {PATH_SQL} AS path, ROW_NUMBER() OVER (ORDER BY {PATH_SQL}) - 1 AS seq FROM documents")
def file_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(_paths(spark, sf_dir).select("path"), "path")


@query("SELECT event_id, ROW_NUMBER() OVER (ORDER BY event_type, value DESC, event_id) AS place FROM events")
def numbered_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return numbered(rows, F.col("event_type"), F.col("value").desc(), F.col("event_id"), name="place", start=1).select("event_id", "place")


# ---- D1, F2, F3: the whole gate ----

# Edges, then a fold in the order of the rows that have an earlier neighbour, carrying whoever was dropped.
FOLD_SQL = """e AS MATERIALIZED (SELECT b.seq AS hi, list({'d': a.seq, 'x': a.digest = b.digest} ORDER BY a.seq) AS ns FROM able a JOIN able b ON a.seq < b.seq AND (a.digest = b.digest OR bit_count(xor(a.h, b.h)) <= 5) GROUP BY b.seq),
o AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (ORDER BY hi) AS n FROM e),
fold AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS dropped, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS STRUCT(d BIGINT, x BOOLEAN)[]) AS alive
  UNION ALL
  SELECT o.n, CASE WHEN len(list_filter(ns, lambda v: NOT list_contains(dropped, v.d))) > 0 THEN list_append(dropped, hi) ELSE dropped END, hi, list_filter(ns, lambda v: NOT list_contains(dropped, v.d)) FROM fold f JOIN o ON o.n = f.n + 1),
again AS (SELECT seq, CASE WHEN len(list_filter(alive, lambda v: v.x)) > 0 THEN 'duplicate:exact' ELSE 'duplicate:near' END AS reason, COALESCE(list_filter(alive, lambda v: v.x)[1].d, alive[1].d) AS lead FROM fold WHERE n > 0 AND len(alive) > 0)"""


@query(
    f"""WITH RECURSIVE {SIMHASH_SQL},
f AS (SELECT doc_id, n_chars, {PATH_SQL} AS path, CASE WHEN n_chars < 60 THEN 'not_an_image:unrecognised_format' WHEN doc_id % 41 = 0 THEN 'unsupported_format:heic_needs_transcode' WHEN doc_id % 43 = 0 THEN 'undecodable:ValueError' END AS bad FROM documents),
numbered AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (ORDER BY path) - 1 AS seq FROM f),
able AS MATERIALIZED (SELECT seq, digest, h FROM numbered JOIN s USING (doc_id) WHERE bad IS NULL),
{FOLD_SQL},
r AS (SELECT n.*, COALESCE(bad, reason) AS reject_reason, CAST(l.doc_id AS VARCHAR) AS duplicate_of FROM numbered n LEFT JOIN again USING (seq) LEFT JOIN (SELECT seq AS lead, doc_id FROM numbered) l USING (lead))
SELECT path, seq, CAST(doc_id AS VARCHAR) AS doc_id, reject_reason, duplicate_of, reject_reason IS NULL AS ok,
  array_to_string(list_filter([CASE WHEN doc_id % 7 = 0 THEN 'truncated_file_recovered' END, CASE WHEN reject_reason IS NULL AND n_chars * 7 % 300 < 150 THEN 'low_sharpness' END, CASE WHEN reject_reason IS NULL AND n_chars * 3 % 180 < 90 THEN 'underexposed' END,
    CASE WHEN reject_reason IS NULL AND (200 + n_chars % 1000) * 500 / 1e6 < 0.15 THEN 'very_low_resolution' END], lambda x: x IS NOT NULL), ';') AS flags FROM r"""
)
def preflight_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as measured files: their own hashes, and sizes and sharpness made from their lengths."""
    rows = _paths(spark, sf_dir).select("path", "doc_id", "n_chars", F.sha2("text", 256).alias("sha256"), "text")
    hashed = with_simhash60(rows, F.col("text"), ["path", "doc_id", "n_chars", "sha256"])
    n, k = F.col("n_chars"), F.col("doc_id")
    screened = F.when(n < 60, "not_an_image:unrecognised_format").when(k % 41 == 0, "unsupported_format:heic_needs_transcode")
    files = hashed.select(
        "path", k.cast("string").alias("doc_id"), F.lit("image/jpeg").alias("mime"), "sha256", screened.alias("_screened"), F.when(screened.isNull() & (k % 43 == 0), "undecodable:ValueError").alias("error"),
        (200 + n % 1000).cast("int").alias("width"), F.lit(500).alias("height"), F.col("h").alias("dhash"), (n * 7 % 300).cast("double").alias("blur"), (n * 3 % 180).cast("double").alias("brightness"), (k % 7 == 0).alias("truncated"),
    )
    return judged(files).select("path", "seq", "doc_id", "reject_reason", "duplicate_of", "ok", F.array_join("quality_flags", ";").alias("flags"))


# ---- J2 across runs ----


@query(ORACLES["near_dedup"])
def near_dedup_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_dedup with the documents in two batches; the second meets the leaders that the first left, by band."""
    docs = table(spark, sf_dir, "documents")
    half = docs.agg(F.max("doc_id")).first()[0] // 2
    index = leaders.LeaderIndex(spark, scratch_path(spark, "leader-index"), 5, bits=60, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed = written(with_simhash60(docs.select("doc_id", F.sha2("text", 256).alias("sha256"), "text"), F.col("text"), ["doc_id", "sha256"]), "hashed")
    first = index.add(hashed.filter(F.col("doc_id") <= half), "first", key="doc_id")
    return first.unionByName(index.add(hashed.filter(F.col("doc_id") > half), "second", key="doc_id"))


# ---- S9, S13, J3: the cache over several writes ----


@query(
    """WITH g AS (SELECT doc_id, sha256(text) AS s FROM documents JOIN labels USING (doc_id) WHERE quality = 1),
p AS (SELECT s, CAST(doc_id AS VARCHAR) AS origin, unnest(list_filter([CASE WHEN doc_id % 2 = 0 THEN 1 END, CASE WHEN doc_id % 3 = 0 THEN 2 END, CASE WHEN doc_id % 5 = 0 THEN 3 END], lambda x: x IS NOT NULL)) AS filed FROM g),
k AS (SELECT s, origin FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY s ORDER BY filed DESC, origin) AS n FROM p) WHERE n = 1)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, origin IS NOT NULL AS hit, origin FROM documents d LEFT JOIN k ON sha256(d.text) = k.s"""
)
def cache_over_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writes that overlap, a compaction between them, one repeated; then all documents are looked up."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    good = F.col("quality") == 1
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    envelopes = rows.select("sha256", F.col("doc_id").cast("string").alias("doc_id"), F.lit("extracted").alias("status"), F.when(good, 0.9).otherwise(0.5).alias("confidence"), F.struct(F.lit(True).alias("passed")).alias("validation"), F.col("doc_id").cast("string").alias("origin"))
    of = lambda n: envelopes.filter(F.col("doc_id").cast("long") % n == 0)
    cache = ResultCache(spark, scratch_path(spark, "cache"), "print", envelopes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cache.put(of(2), "first")
    cache.put(of(3), "second")
    cache.compact()
    cache.put(of(5), "third")
    cache.put(of(5), "third")
    hits, live = cache.lookup(docs.withColumn("doc_id", F.col("doc_id").cast("string")))
    return hits.select("doc_id", F.lit(True).alias("hit"), "origin").unionByName(live.select("doc_id", F.lit(False).alias("hit"), F.lit(None).cast("string").alias("origin")))


# ---- S10, D14: the ledger over repeated jobs ----


@query("SELECT event_type AS stage, COUNT(*) AS calls, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS output_tokens, COUNT(DISTINCT user_id) AS docs FROM events GROUP BY event_type")
def ledger_over_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls appended in three batches, one of them twice, as a job does that is repeated; then read again."""
    rows, path = calls(spark, sf_dir), scratch_path(spark, "ledger")
    rows = rows.select(F.lit("run").alias("run"), "doc_id", "stage", "model", "input_tokens", "output_tokens", "cost_usd", "latency_s", "seq", F.lit(None).cast("double").alias("image_kb"))
    for batch in (0, 1, 1, 2):
        ledger.append_ledger(rows.filter(F.col("seq") % 3 == batch).drop("seq"), path, f"run/{batch}")
    return ledger.read_ledger(spark, path).groupBy("stage").agg(F.count("*").alias("calls"), F.sum("output_tokens").alias("output_tokens"), F.count_distinct("doc_id").alias("docs"))


# ---- A4, A12: sets and quantiles ----


@query(
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS stage, user_id FROM events), f AS (SELECT DISTINCT day AS first_day FROM d)
SELECT strftime(first_day, '%Y-%m-%d') AS first_day, stage, COUNT(DISTINCT user_id) AS n FROM f JOIN d ON d.day >= f.first_day AND d.day < f.first_day + 7 GROUP BY first_day, stage"""
)
def docs_over_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different documents of every seven days, from sets of single days."""
    rows = table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("stage"), F.col("user_id").alias("doc_number"))
    out = rollups.docs_over(written(rollups.daily_docs(rows), "daily"), 7, ["stage"])
    return out.select(F.date_format("first_day", "yyyy-MM-dd").alias("first_day"), "stage", "n")


@query(
    """WITH x AS (SELECT event_type AS stage, CAST(round(value * 1000) AS BIGINT) AS x FROM events WHERE event_type <> 'error' AND value IS NOT NULL),
q AS (SELECT stage, COUNT(*) AS n, unnest([0.5, 0.95, 1.0]) AS share, unnest([quantile_cont(x, 0.5), quantile_cont(x, 0.95), CAST(MAX(x) AS DOUBLE)]) AS y FROM x GROUP BY stage)
SELECT stage, CAST(share AS DOUBLE) AS share, n, ROUND(y / 1000, 6) AS quantile FROM q"""
)
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, 95th percentile and longest latency of each stage, exactly."""
    return rollups.latency(calls(spark, sf_dir), ["stage"], [0.5, 0.95, 1.0]).withColumn("quantile", F.round("quantile", 6))


@query(
    """WITH x AS (SELECT event_type AS stage, value FROM events WHERE value IS NOT NULL), n AS (SELECT stage, COUNT(*) AS n FROM x GROUP BY stage)
SELECT stage, CAST(share AS DOUBLE) AS share, n, TRUE AS within FROM n, (SELECT unnest([0.1, 0.5, 0.9]) AS share)"""
)
def latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of single days, merged; whether each quantile's rank among all values is within the stated error."""
    rows = table(spark, sf_dir, "events").filter("value is not null").select(F.to_date("ts").alias("day"), F.col("event_type").alias("stage"), "value")
    kept = written(quantiles.sketches(rows, ["day", "stage"], F.col("value")), "sketches")
    found = written(quantiles.sketched_quantiles(quantiles.merged(kept, ["stage"]), ["stage"], [0.1, 0.5, 0.9]), "quantiles")
    ranks = rows.join(found, "stage").groupBy("stage", "share", "n", "quantile").agg(F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("up_to"))
    far = quantiles.RANK_ERROR * F.col("n") + 1
    want = F.col("share") * F.col("n")
    return ranks.select("stage", "share", "n", ((F.col("below") <= want + far) & (F.col("up_to") >= want - far)).alias("within"))


@query(
    """WITH k AS (SELECT DISTINCT s FROM (SELECT sha256(text) AS s FROM documents JOIN labels USING (doc_id) WHERE quality = 1))
SELECT COUNT(*) AS n, COUNT(*) FILTER (k.s IS NOT NULL) AS known, CAST(0 AS BIGINT) AS lost, TRUE AS few_passed FROM documents LEFT JOIN k ON sha256(text) = k.s"""
)
def key_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a filter of some contents: none that is known is lost, and of the others less than a hundredth passes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    keys = docs.join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id").select("sha256").distinct()
    marked = bitmaps.may_be_in(docs, bitmaps.key_filter(keys, "sha256"), "sha256").join(keys.withColumn("known", F.lit(True)), "sha256", "left")
    known = F.col("known").isNotNull()
    passed = F.count_if(F.col("maybe") & ~known) * 100 <= F.count("*")
    return marked.agg(F.count("*").alias("n"), F.count_if(known).alias("known"), F.count_if(known & ~F.col("maybe")).alias("lost"), passed.alias("few_passed"))


# ---- A5, A10: counters of the pass that writes ----


@query(
    f"""WITH {VERDICT_SQL} SELECT 'hallucinated_docs' AS list, doc_id FROM v WHERE verdict = 'HALLUCINATED' UNION ALL SELECT 'dropped_real_documents', doc_id FROM v WHERE verdict = 'DROPPED_REAL_DOCUMENT' UNION ALL SELECT 'misrouted', doc_id FROM v WHERE verdict = 'MISROUTED'
UNION ALL SELECT 'dedup_detected', doc_id FROM v WHERE doc_id % 4 = 0 AND verdict = 'correctly_refused' UNION ALL SELECT 'dedup_missed', doc_id FROM v WHERE doc_id % 4 = 0 AND verdict IN ('HALLUCINATED', 'not_refused_but_empty')"""
)
def score_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, results = _judged(spark, sf_dir)
    gold = gold.withColumn("duplicate_of", F.when(F.col("doc_id") % 4 == 0, F.col("doc_id") - 1))
    return scoring.listed(scoring.verdicts(gold, results))


@query(
    f"""WITH {VERDICT_SQL} SELECT COUNT(*) FILTER (verdict = 'routed_ok') AS routing_correct, COUNT(*) FILTER (verdict IN ('routed_ok', 'MISROUTED', 'DROPPED_REAL_DOCUMENT')) AS routing_total,
  COUNT(*) FILTER (verdict = 'correctly_refused') AS refusal_correct, COUNT(*) FILTER (verdict IN ('correctly_refused', 'HALLUCINATED', 'not_refused_but_empty')) AS refusal_total, COUNT(*) FILTER (verdict = 'HALLUCINATED') AS hallucination_count FROM v"""
)
def score_while_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that come with writing the verdicts, as one row."""
    return spark.createDataFrame([scoring.score_while_written(*_judged(spark, sf_dir), scratch_path(spark, "verdicts"))], "routing_correct long, routing_total long, refusal_correct long, refusal_total long, hallucination_count long")


# ---- R2, R3: several answers to one second look ----

BILLS_SQL = """b AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS failed, CASE WHEN o_orderkey % 3 = 0 THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS v, o_totalprice AS p FROM orders),
s0 AS (SELECT *, ROUND(CASE WHEN failed THEN 0.3 ELSE 0 END + v + 0.1, 3) AS s FROM b)"""


@query(
    f"""WITH {BILLS_SQL},
s1 AS (SELECT *, k % 4 = 0 AS four, ROUND(0.3 + v, 3) AS t1, ROUND(greatest(0, least(1, 0.5 + least(s, 0.6)) - least(0.3 + v, 0.6)), 3) AS c1 FROM s0),
s2 AS (SELECT *, ROUND(greatest(0, least(1, c1 + least(t1, 0.6)) - least(v, 0.6)), 3) AS c3, k % 4 = 2 AND v > 0 AS named, ROUND(greatest(0, least(1, 0.5 + least(s, 0.6)) - least(0.4, 0.6)), 3) AS cn FROM s1)
SELECT k AS o_orderkey, CAST(CASE WHEN four THEN v WHEN named THEN 0.4 ELSE s END AS DOUBLE) AS severity, NOT failed OR four AS passed, CAST(CASE WHEN four THEN c3 WHEN named THEN cn ELSE 0.5 END AS DOUBLE) AS confidence,
  CAST(CASE WHEN four THEN 100 WHEN failed THEN -1 ELSE p END AS DOUBLE) AS total, CASE WHEN v = 0 OR named THEN 'Shop' END AS vendor, CASE WHEN four THEN '27AAPFU0939F1ZV' ELSE 'bad' END AS gstin FROM s2"""
)
def reread_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills with up to four patches, some of which better nothing or come twice: each is tried against what the ones before it left."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    data = F.struct(F.when(key % 2 == 0, -1.0).otherwise(F.col("o_totalprice").cast("double")).alias("total_amount"), F.when(key % 3 != 0, "Shop").alias("vendor_name"), F.lit("bad").alias("vendor_gstin"))
    bills = orders.select(key.cast("string").alias("doc_id"), F.lit("vendor_bill").alias("doc_class"), F.lit("extracted").alias("status"), F.lit(0.5).alias("confidence"), F.parse_json(F.to_json(data)).alias("data"))
    bills = rules.validated(bills, AS_OF)
    told = lambda at, **fields: F.struct(F.lit(at).alias("at"), F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in fields.items()])).alias("raw"))
    first = told(1, vendor_gstin="27AAPFU0939F1ZV", other="left out")
    four = F.array(first, first, told(2, total_amount=-2.0), told(3, total_amount=100.0), told(4, vendor_name="Shop"))
    each = orders.select(key.cast("string").alias("doc_id"), F.explode(F.when(key % 4 == 0, four).when(key % 4 == 2, F.array(told(1, vendor_name="Shop")))).alias("p"))
    patches = each.select("doc_id", "p.at", F.parse_json("p.raw").alias("patch"), F.array(*map(F.lit, ("vendor_gstin", "total_amount", "vendor_name"))).alias("fields"))
    out = runs.reread(bills, patches, AS_OF, order_col="at")
    get = lambda name, kind: F.try_variant_get("data", f"$.{name}", kind)
    return out.select(F.col("doc_id").cast("long").alias("o_orderkey"), "validation.severity", "validation.passed", "confidence", get("total_amount", "double").alias("total"), get("vendor_name", "string").alias("vendor"), get("vendor_gstin", "string").alias("gstin"))


# ---- D5, D6, J4: runs over names and answers that repeat ----


def _answers(docs: DataFrame, doc_class: Column) -> DataFrame:
    """Answers of each stage, the first of which a retry gives again with other numbers later."""
    say = lambda stage, at, text: F.struct(F.lit(stage).alias("stage"), F.lit(at).alias("at"), text.alias("text"))
    route = lambda c: F.to_json(F.struct(doc_class.alias("class"), F.lit(c).alias("confidence")))
    body = lambda n: F.struct(F.lit(0.9).alias("confidence"), F.struct((F.col("n_chars") * n).alias("odometer_km")).alias("data"))
    whole = lambda n: F.to_json(F.struct(F.lit("meter_reading").alias("doc_class"), F.lit(0.8).alias("confidence"), F.struct((F.col("n_chars") * n).alias("odometer_km")).alias("data")))
    told = F.array(say("route", 1, route(0.6)), say("route", 2, route(0.7)), say("extract", 1, F.to_json(body(1))), say("extract", 2, F.to_json(body(2))), say("baseline", 1, whole(1)), say("baseline", 3, whole(3)))
    return docs.select("seq", F.explode(told).alias("t")).select("seq", "t.*")


def _files_of_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files whose stems repeat: the hundreds of their ids; seq tells them apart."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("seq"), (F.col("doc_id") % 100).cast("string").alias("doc_id"), "n_chars", "lang", F.sha2("text", 256).alias("sha256"), F.when(F.col("n_chars") < 60, "not_an_image:unrecognised_format").alias("reject_reason"), F.lit(None).cast("string").alias("duplicate_of"), F.array().cast("array<string>").alias("quality_flags"))


@query(
    """SELECT doc_id AS seq, CAST(doc_id % 100 AS VARCHAR) AS doc_id, CASE WHEN n_chars < 60 THEN 'not_a_document' WHEN lang = 'en' THEN 'meter_reading' ELSE 'not_a_document' END AS doc_class, CASE WHEN n_chars >= 60 AND lang = 'en' THEN 'extracted' ELSE 'refused' END AS status,
  CAST(CASE WHEN n_chars < 60 THEN 1.0 WHEN lang = 'en' THEN 0.9 ELSE 0.7 END AS DOUBLE) AS confidence, CASE WHEN n_chars >= 60 AND lang = 'en' THEN n_chars * 2 END AS odometer FROM documents"""
)
def run_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per file, though stems repeat and each call was answered twice; the later answer counts."""
    files = written(_files_of_one_name(spark, sf_dir), "files")
    out = runs.run_optimized(files, _answers(files, F.when(F.col("lang") == "en", "meter_reading").otherwise("not_a_document")), AS_OF, key="seq", order_col="at")
    return out.select("seq", "doc_id", "doc_class", "status", "confidence", F.try_variant_get("data", "$.odometer_km", "long").alias("odometer"))


@query(
    """SELECT doc_id AS seq, CAST(doc_id % 100 AS VARCHAR) AS doc_id, 'meter_reading' AS doc_class, 'extracted' AS status, CAST(0.8 AS DOUBLE) AS confidence, n_chars * 3 AS odometer, n_chars * 3 <= 3000000 AS passed FROM documents"""
)
def baseline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = written(_files_of_one_name(spark, sf_dir), "files")
    out = runs.run_baseline(files, _answers(files, F.lit("meter_reading")), AS_OF, key="seq", order_col="at")
    return out.select("seq", "doc_id", "doc_class", "status", "confidence", F.try_variant_get("data", "$.odometer_km", "long").alias("odometer"), "validation.passed")


# ---- S14, D12: lines of a batch ----


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PROMPT_SQL = "CASE WHEN doc_class = 'vendor_bill' THEN {} WHEN doc_class = 'work_report' THEN {} WHEN doc_id % 3 = 0 THEN {} ELSE {} END".format(
    *(_quoted(classes.extraction_prompt(*c)) for c in (("vendor_bill",), ("work_report",), ("meter_reading", next(iter(classes.SUBTYPES))), ("meter_reading",)))
)
NOTES_SQL = " || ".join(f"CASE WHEN {cond} THEN chr(10) || {_quoted(classes.QUALITY_NOTES[flag])} ELSE '' END" for flag, cond in (("truncated_file_recovered", "doc_id % 7 = 0"), ("underexposed", "doc_id % 5 = 0")))
MOST_SQL = "CASE doc_class " + " ".join(f"WHEN '{name}' THEN {most}" for name, _, _, _, most in classes.POLICIES) + " END"


@query(
    f"""WITH d AS (SELECT doc_id, text, ['work_report', 'vendor_bill', 'meter_reading', 'not_a_document'][doc_id % 4 + 1] AS doc_class FROM documents),
p AS (SELECT *, {PROMPT_SQL} || {NOTES_SQL} AS prompt, {MOST_SQL} AS most FROM d WHERE doc_class <> 'not_a_document')
SELECT doc_id, sha256('{{"custom_id":"' || doc_id || '","method":"POST","url":"/v1/chat/completions","body":{{"model":"{classes.POLICIES[0][1]}","max_tokens":' || most || ',"messages":[{{"role":"user","content":[{{"type":"text","text":' || CAST(to_json(prompt) AS VARCHAR)
  || '}},{{"type":"image_url","image_url":{{"url":"data:image/jpeg;base64,' || base64(encode(text)) || '"}}}}]}}]}}}}') AS line FROM p"""
)
def batch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction requests of all documents that are routed to a class, with what their flags mean."""
    docs, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    flags = F.array_compact(F.array(F.when(k % 7 == 0, "truncated_file_recovered"), F.when(k % 5 == 0, "underexposed"), F.lit("unheard_of")))
    files = docs.select(k.cast("string").alias("doc_id"), F.col("text").cast("binary").alias("content"), flags.alias("quality_flags"))
    chosen = F.element_at(F.array(*[F.lit(c) for c in ("work_report", "vendor_bill", "meter_reading", "not_a_document")]), (k % 4 + 1).cast("int"))
    routes = docs.select(k.cast("string").alias("doc_id"), chosen.alias("doc_class"), F.when(k % 3 == 0, next(iter(classes.SUBTYPES))).alias("subtype"))
    lines = runs.batch_requests(files, "extract", routes)
    return lines.select(F.get_json_object("value", "$.custom_id").cast("long").alias("doc_id"), F.sha2("value", 256).alias("line"))


# ---- J6, D13: costs of names that repeat ----


@query(
    f"""WITH {CALLS_SQL}, c AS (SELECT CAST(CAST(doc_id AS BIGINT) % 1000 AS VARCHAR) AS name, COUNT(*) AS n, CAST(SUM(CAST(micro AS DECIMAL(18, 4))) / 1000000 AS DOUBLE) AS usd FROM priced GROUP BY name)
SELECT d.doc_id AS seq, CAST(d.doc_id % 1000 AS VARCHAR) AS name, COALESCE(n, 0) AS n_calls, ROUND(COALESCE(usd, 0), 8) AS cost_usd FROM documents d LEFT JOIN c ON c.name = CAST(d.doc_id % 1000 AS VARCHAR)"""
)
def costs_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance of files whose stems repeat: calls of a stem belong to each file of it, and files stay as many as they are."""
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), (F.col("doc_id") % 1000).cast("string").alias("doc_id"))
    named = calls(spark, sf_dir).withColumn("doc_id", (F.col("doc_id").cast("long") % 1000).cast("string"))
    out = runs.with_provenance(files, named)
    return out.select("seq", F.col("doc_id").alias("name"), F.size("provenance.calls").cast("long").alias("n_calls"), F.round("provenance.cost_usd", 8).alias("cost_usd"))
