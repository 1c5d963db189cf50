"""Queries over the star-schema tables that exercise each operator, with equivalent SQL.

Stand-ins: events are ledger rows (event_type the stage, user_id the document, props.k the tokens),
orders with lineitem are bills with their lines, documents and pages are files, documents with labels are
results with gold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions.cost import priced, prices
from .functions.hashes import difference_hash, hamming, with_simhash60
from .functions.json_repair import expand_rows, with_json
from .functions.numbers import number_from_text, numbers_match
from .operators import leaders, rollups, rules, scoring
from .plans import classes, runs
from .sources import cache, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- ledger ----

CALLS_SQL = """calls AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS doc_id, event_type AS stage,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'gpt-4o' WHEN event_type = 'error' THEN '-' ELSE 'gpt-4o-mini' END AS model,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 AS input_tokens, CAST(json_extract_string(props, '$.k') AS BIGINT) AS output_tokens,
    0 AS cache_write_tokens, CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS cache_read_tokens, value AS latency_s FROM events),
priced AS (
  SELECT calls.*, CASE model WHEN 'gpt-4o' THEN (input_tokens * 2.50 + output_tokens * 10.00 + cache_read_tokens * 1.25)
    WHEN 'gpt-4o-mini' THEN (input_tokens * 0.150 + output_tokens * 0.60 + cache_read_tokens * 0.075) ELSE 0 END AS micro FROM calls)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls with their cost."""
    tokens = F.get_json_object("props", "$.k").cast("long")
    model = F.when(F.col("event_type").isin("purchase", "signup"), "gpt-4o").when(F.col("event_type") == "error", "-").otherwise("gpt-4o-mini")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("doc_id"),
        F.col("event_type").alias("stage"),
        model.alias("model"),
        (tokens * 100).alias("input_tokens"),
        tokens.alias("output_tokens"),
        F.lit(0).cast("long").alias("cache_write_tokens"),
        (tokens * 10).alias("cache_read_tokens"),
        F.col("value").alias("latency_s"),
    )
    return priced(rows, prices(spark))


@query(
    f"""WITH {CALLS_SQL}
SELECT CASE WHEN GROUPING(stage) = 0 THEN 'stage' WHEN GROUPING(paid_model) = 0 THEN 'model' ELSE 'total' END AS scope, COALESCE(stage, paid_model) AS name,
  COUNT(*) AS calls, COUNT(*) FILTER (model <> '-') AS paid, CAST(SUM(input_tokens) AS BIGINT) AS input_tokens, CAST(SUM(output_tokens) AS BIGINT) AS output_tokens,
  CAST(SUM(cache_write_tokens) AS BIGINT) AS cache_write, CAST(SUM(cache_read_tokens) AS BIGINT) AS cache_read, CAST(SUM(CAST(micro AS DECIMAL(18, 4))) / 1000000 AS DOUBLE) AS cost_usd
FROM (SELECT *, CASE WHEN model <> '-' THEN model END AS paid_model FROM priced)
GROUP BY GROUPING SETS ((stage), (paid_model), ())
HAVING NOT (GROUPING(paid_model) = 0 AND paid_model IS NULL)"""
)
def ledger_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup(calls(spark, sf_dir)).withColumn("cost_usd", F.col("cost_usd").cast("double"))


@query(
    f"""WITH {CALLS_SQL}
SELECT COUNT(DISTINCT doc_id) AS docs, COUNT(*) FILTER (model <> '-') AS calls, CAST(SUM(input_tokens) AS BIGINT) AS input_tokens, CAST(SUM(output_tokens) AS BIGINT) AS output_tokens,
  CAST(SUM(CAST(micro AS DECIMAL(18, 4))) / 1000000 AS DOUBLE) AS cost_usd, CAST(SUM(CAST(latency_s AS DECIMAL(18, 3))) AS DOUBLE) AS latency_s,
  ROUND(COUNT(*) FILTER (model <> '-') / COUNT(DISTINCT doc_id), 3) AS calls_per_doc FROM priced"""
)
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollups.summary(calls(spark, sf_dir))
    return out.select("docs", "calls", "input_tokens", "output_tokens", F.col("cost_usd").cast("double").alias("cost_usd"), F.col("latency_s").cast("double").alias("latency_s"), "calls_per_doc")


@query(f"WITH {CALLS_SQL} SELECT doc_id, ROUND(CAST(SUM(CAST(micro AS DECIMAL(18, 4))) / 1000000 AS DOUBLE), 8) AS cost_usd, COUNT(*) AS n_calls, MIN(seq) AS first_call FROM priced GROUP BY doc_id")
def cost_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir)
    firsts = rows.groupBy("doc_id").agg(F.min("seq").alias("first_call"))
    return rollups.cost_per_doc(rows).join(firsts, "doc_id").select("doc_id", "cost_usd", F.size("calls").cast("long").alias("n_calls"), "first_call")


@query(
    f"""WITH {CALLS_SQL}, a AS (SELECT ROUND(CAST(SUM(CAST(micro AS DECIMAL(18, 4))) / 1000000 AS DOUBLE) / COUNT(DISTINCT doc_id), 6) AS c FROM priced WHERE stage IN ('purchase', 'signup', 'error')),
b AS (SELECT ROUND(CAST(SUM(CAST(micro AS DECIMAL(18, 4))) / 1000000 AS DOUBLE) / COUNT(DISTINCT doc_id), 6) AS c FROM priced WHERE stage IN ('view', 'click'))
SELECT a.c AS baseline_cost, b.c AS optimized_cost, ROUND(a.c / b.c, 2) AS times_cheaper, ROUND(100 * (1 - b.c / a.c), 2) AS percent_saved FROM a, b"""
)
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir)
    return rollups.comparison(rollups.summary(rows.filter(F.col("stage").isin("purchase", "signup", "error"))), rollups.summary(rows.filter(F.col("stage").isin("view", "click"))))


# ---- scalars ----


@query("SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents")
def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.norm_text(F.col("text")).alias("norm"))


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS code FROM customer")
def norm_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", T.norm_code(F.col("c_name")).alias("code"))


@query(
    """SELECT p_partkey, TRY_CAST(NULLIF(regexp_replace(p_brand, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE) AS brand_number,
  TRY_CAST(regexp_replace('Rs ' || CAST(p_size AS VARCHAR) || ',000.50 only', '[^0-9.\\-]', '', 'g') AS DOUBLE) AS amount,
  TRY_CAST(NULLIF(regexp_replace(p_name, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE) AS name_number FROM part"""
)
def coerce_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.concat(F.lit("Rs "), F.col("p_size").cast("string"), F.lit(",000.50 only"))
    return table(spark, sf_dir, "part").select("p_partkey", number_from_text(F.col("p_brand")).alias("brand_number"), number_from_text(amount).alias("amount"), number_from_text(F.col("p_name")).alias("name_number"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE CASE WHEN l_extendedprice = 0 THEN abs(l_quantity * p_retailprice) < 1e-9 ELSE abs(l_quantity * p_retailprice - l_extendedprice) <= greatest(abs(l_extendedprice) * 0.02, 0.01) END"""
)
def num_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return both.filter(numbers_match(F.col("l_quantity") * F.col("p_retailprice"), F.col("l_extendedprice"), 0.02)).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(
    """SELECT p_partkey, p_name, lower(p_name) LIKE '%widget%' AND length('widget') >= 5 AS has_widget,
  (lower(p_name) = lower(p_type) OR ((contains(lower(p_name), lower(p_type)) OR contains(lower(p_type), lower(p_name))) AND least(length(p_name), length(p_type)) >= 5)) AS same FROM part"""
)
def text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", T.texts_match(F.col("p_name"), F.lit("Widget")).alias("has_widget"), T.texts_match(F.col("p_name"), F.col("p_type")).alias("same"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CAST(ts AS DATE) BETWEEN DATE '2015-01-01' AND DATE '2024-01-17' AS valid FROM events")
def valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select("event_id", day.alias("day"), T.is_recent_date(day, F.lit("2024-01-15").cast("date")).alias("valid"))


@query("SELECT doc_id, lower(trim(source)) IN ('n/a', 'test', 'src0') AS known, lower(trim(lang)) IN ('na', 'none') AS placeholder FROM documents")
def placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", (T.is_placeholder(F.col("source")) | (F.col("source") == "src0")).alias("known"), T.is_placeholder(F.col("lang")).alias("placeholder"))


# ---- duplicates ----


@query("SELECT doc_id, CASE WHEN doc_id > MIN(doc_id) OVER (PARTITION BY sha256(text)) THEN MIN(doc_id) OVER (PARTITION BY sha256(text)) END AS duplicate_of FROM documents")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaders.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256")))


SIMHASH_SQL = """w AS (SELECT doc_id, text, list_transform(list_filter(list_distinct(string_split(text, ' ')), lambda w: w <> ''), lambda w: CAST('0x' || substr(md5(w), 1, 15) AS BIGINT)) AS hs FROM documents),
s AS MATERIALIZED (SELECT doc_id, sha256(text) AS digest, CAST(list_sum(list_transform(range(0, 60), lambda b: CASE WHEN 2 * len(list_filter(hs, lambda h: (h >> b) & 1 = 1)) > len(hs) THEN CAST(1 AS BIGINT) << b ELSE 0 END)) AS BIGINT) AS h FROM w)"""


@query(
    # Edges first; then a fold, in order, over those that have an earlier neighbour, carrying whoever was dropped.
    f"""WITH RECURSIVE {SIMHASH_SQL},
e AS MATERIALIZED (SELECT b.doc_id AS hi, list({{'d': a.doc_id, 'x': a.digest = b.digest}} ORDER BY a.doc_id) AS ns FROM s a JOIN s b ON a.doc_id < b.doc_id AND (a.digest = b.digest OR bit_count(xor(a.h, b.h)) <= 5) GROUP BY b.doc_id),
o AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (ORDER BY hi) AS n FROM e),
fold AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS dropped, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS STRUCT(d BIGINT, x BOOLEAN)[]) AS alive
  UNION ALL
  SELECT o.n, CASE WHEN len(list_filter(ns, lambda v: NOT list_contains(dropped, v.d))) > 0 THEN list_append(dropped, hi) ELSE dropped END, hi, list_filter(ns, lambda v: NOT list_contains(dropped, v.d)) FROM fold f JOIN o ON o.n = f.n + 1),
r AS (SELECT doc_id, CASE WHEN len(list_filter(alive, lambda v: v.x)) > 0 THEN 'duplicate:exact' ELSE 'duplicate:near' END AS reason, COALESCE(list_filter(alive, lambda v: v.x)[1].d, alive[1].d) AS duplicate_of FROM fold WHERE n > 0 AND len(alive) > 0)
SELECT s.doc_id, r.reason, r.duplicate_of FROM s LEFT JOIN r USING (doc_id)"""
)
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), "text")
    return leaders.greedy_leaders(with_simhash60(docs, F.col("text"), ["doc_id", "sha256"]), 5, key="doc_id", bits=60)


@query("SELECT vec_id, CAST(list_reduce(list_transform(range(1, 64), lambda k: CASE WHEN embedding[k] < embedding[k + 1] THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END), lambda a, x: a * 2 + x) AS BIGINT) AS dhash FROM embeddings")
def dhash_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", difference_hash(F.col("embedding")).alias("dhash"))


@query(
    """WITH h AS (SELECT vec_id, CAST(list_reduce(list_transform(range(1, 64), lambda k: CASE WHEN embedding[k] < embedding[k + 1] THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END), lambda a, x: a * 2 + x) AS BIGINT) AS h FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.h, b.h)) <= 14"""
)
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", difference_hash(F.col("embedding")).alias("h"))
    pairs = leaders.near_pairs(rows.select("h").distinct(), 14).withColumnRenamed("a", "ha").withColumnRenamed("b", "hb")
    same = rows.select(F.col("h").alias("ha")).distinct().select("ha", F.col("ha").alias("hb"))
    x, y = rows.select(F.col("vec_id").alias("x"), F.col("h").alias("ha")), rows.select(F.col("vec_id").alias("y"), F.col("h").alias("hb"))
    found = pairs.unionByName(same).join(x, "ha").join(y, "hb").filter("x <> y")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), hamming(F.col("ha"), F.col("hb")).alias("distance")).distinct()


# ---- files ----


@query(
    """WITH f AS (SELECT 'page' AS kind, page_id AS id, html AS body FROM pages UNION ALL SELECT 'doc', doc_id, text FROM documents)
SELECT kind, id, CASE WHEN body LIKE 'BM%' THEN 'image/bmp' WHEN body LIKE 'GIF87a%' OR body LIKE 'GIF89a%' THEN 'image/gif' END AS mime,
  CASE WHEN NOT (body LIKE 'BM%' OR body LIKE 'GIF87a%' OR body LIKE 'GIF89a%') THEN 'not_an_image:' ||
    CASE WHEN contains(lower(substr(body, 1, 64)), '<!doctype') OR contains(lower(substr(body, 1, 64)), '<html') THEN 'html_error_page' ELSE 'unrecognised_format' END END AS reject_reason FROM f"""
)
def sniff_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").cast("binary").alias("content"))
    docs = table(spark, sf_dir, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("content"))
    return files.screened(pages.unionByName(docs)).select("kind", "id", "mime", "reject_reason")


# ---- rules ----


@query(
    """WITH s AS (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS line_sum, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey),
b AS (SELECT o_orderkey, o_totalprice AS total, line_sum, n FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
SELECT o_orderkey, COALESCE(n, 0) > 0 AND line_sum > 0 AND abs(line_sum - total) > greatest(2.0, 0.03 * total) AS total_mismatch, total <= 0 AS non_positive, total > 5000000 AS implausible FROM b"""
)
def bill_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("line_sum"))
    bills = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    none = F.lit(None).cast("double")
    one = F.when(F.col("line_sum").isNotNull(), F.array(F.struct(none.alias("qty"), none.alias("rate"), F.col("line_sum").cast("double").alias("amount"))))
    view = rules.bill_view(one, F.col("o_totalprice"), vendor=F.lit("seller"))
    out = rules.validated_bills(bills.select("o_orderkey", view.alias("bill")), "2024-01-15")
    has = lambda prefix: F.exists("validation.issues", lambda i: i.startswith(prefix))
    return out.select("o_orderkey", has("total_mismatch").alias("total_mismatch"), has("non_positive_total").alias("non_positive"), has("implausible_total").alias("implausible"))


LINES_SQL = "l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda s: lower(trim(s))), lambda s: s <> '') AS lines FROM documents), r AS (SELECT doc_id, len(lines) AS n, len(lines) - len(list_distinct(lines)) AS again FROM l)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.filter(F.transform(F.split("text", "\n"), lambda s: F.lower(F.trim(s))), lambda s: s != "")
    return table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"))


@query(f"WITH {LINES_SQL} SELECT doc_id, 'repeated_rows:' || again || '/' || n AS issue FROM r WHERE n >= 4 AND again >= greatest(3, CAST(floor(n * 0.6) AS INTEGER))")
def repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", rules.repeat_issue(F.col("lines"))["issue"].alias("issue")).filter("issue is not null")


@query(
    f"""WITH {LINES_SQL}, w AS (SELECT r.doc_id, CASE WHEN n >= 4 AND again >= greatest(3, CAST(floor(n * 0.6) AS INTEGER)) THEN 0.3 ELSE 0 END AS a, CASE WHEN n_chars < 100 THEN 0.2 ELSE 0 END AS b, CASE WHEN d.lang <> 'en' THEN 0.15 ELSE 0 END AS c, n_chars FROM r JOIN documents d USING (doc_id))
SELECT doc_id, a = 0 AS passed, ROUND(CAST(least(1.0, a + b + c) AS DOUBLE), 3) AS severity, ROUND(greatest(0.0, CAST(0.9 AS DOUBLE) - least(CAST(a + b + c AS DOUBLE), 0.6)), 3) AS confidence FROM w"""
)
def severity_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    issues = rules.some(rules.repeat_issue(F.col("lines")), F.when(F.col("n_chars") < 100, rules.issue("short", 0.2)), F.when(F.col("lang") != "en", rules.issue("language", 0.15)))
    folded = rows.select("doc_id", rules.fold(issues).alias("v"))
    return folded.select("doc_id", "v.passed", "v.severity", rules.effective_confidence(F.lit(0.9), F.col("v.severity")).alias("confidence"))


# ---- scoring ----

VERDICT_SQL = """g AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'work_report' ELSE 'vendor_bill' END AS class, CASE WHEN source = 'src0' THEN 'refuse' ELSE 'extract' END AS expect FROM documents),
v AS (SELECT g.doc_id, expect, CASE WHEN l.doc_id IS NULL THEN 'no_result' WHEN expect = 'refuse' AND quality = 0 THEN 'correctly_refused' WHEN expect = 'refuse' AND toxic = 1 THEN 'HALLUCINATED' WHEN expect = 'refuse' THEN 'not_refused_but_empty'
  WHEN quality = 0 THEN 'DROPPED_REAL_DOCUMENT' WHEN class = CASE WHEN toxic = 1 THEN 'vendor_bill' ELSE 'work_report' END THEN 'routed_ok' ELSE 'MISROUTED' END AS verdict FROM g LEFT JOIN labels l USING (doc_id))"""


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    gold = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", "work_report").otherwise("vendor_bill").alias("class"), F.when(F.col("source") == "src0", "refuse").otherwise("extract").alias("expect"))
    results = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "vendor_bill").otherwise("work_report").alias("doc_class"),
        F.when(F.col("quality") == 0, "refused").otherwise("extracted").alias("status"),
        F.when(F.col("toxic") == 1, F.parse_json(F.lit('{"total_amount": 1}'))).alias("data"),
    )
    return gold, results


@query(f"WITH {VERDICT_SQL} SELECT doc_id, verdict FROM v")
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.verdicts(*_judged(spark, sf_dir)).select("doc_id", "verdict")


@query(
    f"""WITH {VERDICT_SQL}, c AS (SELECT COUNT(*) FILTER (verdict = 'routed_ok') AS routing_correct, COUNT(*) FILTER (expect = 'extract' AND verdict <> 'no_result') AS routing_total,
  COUNT(*) FILTER (verdict = 'correctly_refused') AS refusal_correct, COUNT(*) FILTER (expect = 'refuse' AND verdict <> 'no_result') AS refusal_total, COUNT(*) FILTER (verdict = 'HALLUCINATED') AS hallucination_count FROM v)
SELECT *, ROUND(CAST(routing_correct AS DOUBLE) / NULLIF(routing_total, 0), 4) AS routing_accuracy, ROUND(CAST(refusal_correct AS DOUBLE) / NULLIF(refusal_total, 0), 4) AS refusal_accuracy FROM c"""
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(*_judged(spark, sf_dir)).select("routing_correct", "routing_total", "refusal_correct", "refusal_total", "hallucination_count", "routing_accuracy", "refusal_accuracy")


@query(
    """WITH b AS (SELECT list_distinct(flatten(list(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')))) AS known FROM benchmark),
d AS (SELECT doc_id, list_distinct(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')) AS ws FROM documents)
SELECT doc_id, len(list_filter(ws, lambda w: list_contains(known, w))) AS n_hit, len(list_filter(ws, lambda w: NOT list_contains(known, w))) AS n_missing FROM d, b"""
)
def set_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents against those of the benchmark, joined by word and added up per document where they were read."""
    known = table(spark, sf_dir, "benchmark").select(F.explode(scoring.words(F.col("text"))).alias("w")).distinct()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_distinct(scoring.words(F.col("text"))).alias("ws"))
    rows = docs.select("doc_id", F.explode_outer("ws").alias("w")).join(known.withColumn("hit", F.lit(1)), "w", "left")
    return rows.groupBy("doc_id").agg(F.count("hit").alias("n_hit"), (F.count("w") - F.count("hit")).alias("n_missing"))


# ---- cache, union, runs ----


@query(
    """WITH k AS (SELECT DISTINCT sha256(text) AS s FROM documents JOIN labels USING (doc_id) WHERE quality = 1)
SELECT doc_id, sha256(text) IN (SELECT s FROM k) AS hit FROM documents"""
)
def cache_hit_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    good = docs.join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id")
    kept = good.groupBy("sha256").agg(F.min("doc_id").alias("doc_id")).select("sha256", "doc_id", F.lit("extracted").alias("status"), F.lit(0.9).alias("confidence"), F.struct(F.lit(True).alias("passed")).alias("validation"))
    hits, live = cache.lookup(docs, kept)
    return hits.select("doc_id", F.lit(True).alias("hit")).unionByName(live.select("doc_id", F.lit(False).alias("hit")))


@query(
    """SELECT doc_id, 'refused' AS status, CASE WHEN contains(text, '|') THEN 'duplicate' ELSE 'not_a_document' END AS doc_class FROM documents WHERE n_chars < 200
UNION ALL SELECT doc_id, 'extracted', 'work_report' FROM documents WHERE n_chars >= 200"""
)
def union_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    reason = F.when(F.col("text").contains("|"), "unsupported_format:heic_needs_transcode").otherwise("not_an_image:unrecognised_format")
    rejected = runs.refused_files(docs.filter("n_chars < 200").select("doc_id", reason.alias("reject_reason"), F.lit(None).cast("bigint").alias("duplicate_of")))
    rest = docs.filter("n_chars >= 200").select("doc_id", F.lit("extracted").alias("status"), F.lit("work_report").alias("doc_class"))
    return rejected.select("doc_id", "status", "doc_class").unionByName(rest)


# The same fold over all characters in SQL; a state is a struct of the shape of the elements.
REPAIR_SQL = """m AS (SELECT conv_id, turn, CAST(to_json({'class': role, 'note': text, 'rows': [turn]}) AS VARCHAR) AS body FROM conversations),
t AS (SELECT conv_id, turn, CASE turn WHEN 0 THEN body WHEN 1 THEN '```json' || chr(10) || body || chr(10) || '```' WHEN 2 THEN 'Here: ' || body || ' Done.' ELSE trim(substr(body, 1, 60)) END AS bare FROM m),
f AS (SELECT *, CASE WHEN json_valid(bare) THEN '' WHEN regexp_matches(bare, '(?s)```.*```') AND json_valid(trim(regexp_extract(bare, '(?s)```(?:json)?\\s*(.*?)```', 1), chr(10))) THEN 'unfenced' END AS early,
  trim(regexp_extract(bare, '(?s)```(?:json)?\\s*(.*?)```', 1), chr(10)) AS inner_text, regexp_extract(bare, '(?s)[{\\[].*') AS rest FROM t),
s AS (SELECT *, list_reduce(list_prepend({'c': '', 'k': 0, 'stack': '', 'inside': FALSE, 'skip': FALSE, 'ended': 0}, list_transform(range(1, length(rest) + 1), lambda k: {'c': rest[k], 'k': k, 'stack': '', 'inside': FALSE, 'skip': FALSE, 'ended': 0})),
  lambda a, x: CASE WHEN a.ended > 0 THEN a
    WHEN a.skip THEN {'c': '', 'k': 0, 'stack': a.stack, 'inside': a.inside, 'skip': FALSE, 'ended': 0}
    WHEN a.inside AND x.c = chr(92) THEN {'c': '', 'k': 0, 'stack': a.stack, 'inside': TRUE, 'skip': TRUE, 'ended': 0}
    WHEN x.c = '"' THEN {'c': '', 'k': 0, 'stack': a.stack, 'inside': NOT a.inside, 'skip': FALSE, 'ended': 0}
    WHEN a.inside THEN a
    WHEN x.c IN ('{', '[') THEN {'c': '', 'k': 0, 'stack': CASE x.c WHEN '{' THEN '}' ELSE ']' END || a.stack, 'inside': FALSE, 'skip': FALSE, 'ended': 0}
    WHEN a.stack <> '' AND x.c = a.stack[1] THEN {'c': '', 'k': 0, 'stack': substr(a.stack, 2), 'inside': FALSE, 'skip': FALSE, 'ended': CASE WHEN length(a.stack) = 1 THEN x.k ELSE 0 END}
    ELSE a END) AS z FROM f),
c AS (SELECT *, CASE WHEN z.ended > 0 THEN substr(rest, 1, z.ended) ELSE rtrim(rtrim(rest || CASE WHEN z.inside THEN '"' ELSE '' END), ',') || z.stack END AS candidate FROM s)"""


@query(
    f"""WITH {REPAIR_SQL}
SELECT conv_id, turn, CAST(CASE WHEN early = '' THEN json(bare) WHEN early = 'unfenced' THEN json(inner_text) WHEN rest <> '' AND json_valid(candidate) THEN json(candidate) END AS VARCHAR) AS value,
  CASE WHEN early IS NOT NULL THEN early WHEN rest = '' THEN 'no_json_object' WHEN NOT json_valid(candidate) THEN 'unparseable:no_valid_json' WHEN z.ended > 0 THEN 'trimmed' ELSE 'repaired_truncated' END AS parse_note FROM c"""
)
def json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as model output: bare, fenced, with prose around, and cut off."""
    body = F.to_json(F.struct(F.col("role").alias("class"), F.col("text").alias("note"), F.array("turn").alias("rows")))
    fence = F.lit("```")
    made = F.when(F.col("turn") == 0, body).when(F.col("turn") == 1, F.concat(fence, F.lit("json\n"), body, F.lit("\n"), fence)).when(F.col("turn") == 2, F.concat(F.lit("Here: "), body, F.lit(" Done."))).otherwise(F.expr("substring(to_json(named_struct('class', role, 'note', text, 'rows', array(turn))), 1, 60)"))
    rows = with_json(table(spark, sf_dir, "conversations").select("conv_id", "turn", made.alias("text")))
    return rows.select("conv_id", "turn", F.to_json("value").alias("value"), "parse_note")


@query("SELECT event_id, event_type AS description, CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty, CAST(NULL AS VARCHAR) AS hsn FROM events")
def compact_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat(F.lit('[["'), F.col("event_type"), F.lit('",null,'), F.get_json_object("props", "$.k"), F.lit("], 7]"))
    out = table(spark, sf_dir, "events").select("event_id", F.explode(expand_rows(F.parse_json(row), classes.ROW_COLUMNS["line_items"])).alias("o"))
    return out.select("event_id", F.get_json_object("o", "$.description").alias("description"), F.get_json_object("o", "$.qty").cast("long").alias("qty"), F.get_json_object("o", "$.hsn").alias("hsn"))


@query(
    """WITH d AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id),
e AS (SELECT *, length(t) AS n, substr(t, 1, 12) AS v, CASE WHEN length(t) < 60 THEN 'rejected' ELSE ['work_report', 'vendor_bill', 'meter_reading', 'not_a_document'][conv_id % 4 + 1] END AS c FROM d),
i AS (SELECT *, list_filter([CASE WHEN c = 'work_report' THEN 'entries_not_a_list' END, CASE WHEN c = 'vendor_bill' AND trim(v) = '' THEN 'missing_vendor_name' END], lambda x: x IS NOT NULL) AS l FROM e)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CASE WHEN c = 'rejected' THEN 'not_a_document' ELSE c END AS doc_class, CASE WHEN c IN ('rejected', 'not_a_document') THEN 'refused' ELSE 'extracted' END AS status,
  CASE WHEN c = 'rejected' THEN 1.0 WHEN c = 'not_a_document' THEN 0.9 ELSE ROUND(CAST(0.95 AS DOUBLE) - CASE WHEN len(l) = 0 THEN 0 WHEN c = 'work_report' THEN 0.5 ELSE 0.15 END, 3) END::DOUBLE AS confidence,
  CASE WHEN c IN ('work_report', 'vendor_bill', 'meter_reading') THEN '{"odometer_km":' || n || ',"total_amount":' || n || ',"vendor_name":' || CAST(to_json(v) AS VARCHAR) || '}' END AS data,
  c <> 'work_report' AS passed, array_to_string(l, ';') AS issues FROM i"""
)
def optimized_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screening, routing, extraction and validation over replayed responses: whole conversations stand for files and for the model."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    docs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns")).select(F.col("conv_id").cast("string").alias("doc_id"), "conv_id", F.array_join("turns.text", "\n").alias("text"))
    inbox = docs.select("doc_id", F.sha2("text", 256).alias("sha256"), F.when(F.length("text") < 60, "not_an_image:unrecognised_format").alias("reject_reason"), F.lit(None).cast("string").alias("duplicate_of"), F.array().cast("array<string>").alias("quality_flags"))
    chosen = F.element_at(F.array(*[F.lit(c) for c in classes.CLASSES]), (F.pmod(F.col("conv_id"), F.lit(4)) + 1).cast("int"))
    route = F.to_json(F.struct(chosen.alias("class"), F.lit(0.9).alias("confidence")))
    data = F.to_json(F.struct(F.lit(0.95).alias("confidence"), F.struct(F.length("text").alias("total_amount"), F.substring("text", 1, 12).alias("vendor_name"), F.length("text").alias("odometer_km")).alias("data")))
    stage = F.explode(F.array(F.struct(F.lit("route").alias("stage"), route.alias("text")), F.struct(F.lit("extract").alias("stage"), data.alias("text"))))
    responses = docs.select("doc_id", stage.alias("s")).select("doc_id", "s.stage", "s.text")
    out = runs.run_optimized(inbox, responses, "2024-01-15")
    return out.select("doc_id", "doc_class", "status", "confidence", F.to_json("data").alias("data"), "validation.passed", F.array_join("validation.issues", ";").alias("issues"))
