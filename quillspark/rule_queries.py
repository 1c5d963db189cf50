"""Queries over built records: each validation rule, field scores, screening and routing, with equivalent SQL.

The test tables hold no bills, reports or readings, so records are made from `part` and `customer` by
arithmetic on their keys, so that each rule meets rows on both sides of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions.numbers import number_from_variant
from .operators import rollups, rules, scoring
from .plans import classes, runs
from .queries import ORACLES, QUERIES, query, table
from .sources import files

__all__ = ["ORACLES", "QUERIES"]

AS_OF = "2024-01-15"


def _has(prefix: str) -> Column:
    return F.exists("validation.issues", lambda i: i.startswith(prefix))


def _count(prefix: str) -> Column:
    return F.size(F.filter("validation.issues", lambda i: i.startswith(prefix))).cast("long")


def _records(rows: DataFrame, doc_class: str, **fields: Column) -> DataFrame:
    """rows with `data`, a variant of the fields, null ones left out, and their validation."""
    data = F.parse_json(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])))
    return rules.validated(rows.withColumns({"doc_class": F.lit(doc_class), "data": data}), AS_OF)


def _by(key: Column, n: int, *cases: tuple[int, Column], otherwise: Column | None = None) -> Column:
    """The first case (r, value) with key modulo n equal to r."""
    out = reduce(lambda acc, c: acc.when(key % n == c[0], c[1]) if acc is not None else F.when(key % n == c[0], c[1]), cases, None)
    return out if otherwise is None else out.otherwise(otherwise)


# ---- V16 to V24, A9: meter readings ----


@query(
    """WITH r AS (SELECT p_partkey AS k, p_size AS s, p_retailprice AS p,
  CASE WHEN p_partkey % 5 = 0 THEN 'speedometer' WHEN p_partkey % 7 <> 0 THEN 'odometer' END AS kind,
  CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 9 = 0 THEN 3500000.0 ELSE p_partkey * 1000 + 0.0 END AS odo,
  CASE WHEN p_partkey % 3 = 0 THEN p_retailprice WHEN p_partkey % 3 = 1 THEN 12.0 END AS trip, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS DOUBLE) END AS litres,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(90.5 AS DOUBLE) END AS rate, CASE WHEN p_partkey % 8 = 0 THEN p_size * CAST(90.5 AS DOUBLE) WHEN p_partkey % 8 = 4 THEN p_size * CAST(90.5 AS DOUBLE) * 1.5 END AS amount,
  CASE WHEN p_partkey % 10 = 0 THEN 120.0 WHEN p_partkey % 10 = 5 THEN 32.5 END AS urea, p_partkey % 6 AS d FROM part),
f AS (SELECT k, kind IS NOT NULL AND kind <> 'odometer' AS unknown_type, COALESCE(odo NOT BETWEEN 0 AND 3000000, false) AS odometer,
  COALESCE(litres > 0 AND abs(litres * rate - amount) > greatest(2.0, 0.03 * amount), false) AS dispenser_math, COALESCE(urea NOT BETWEEN 0 AND 100, false) AS urea,
  CASE WHEN amount IS NULL AND litres IS NULL THEN (rate IS NOT NULL)::BIGINT + (urea IS NOT NULL)::BIGINT ELSE 0 END AS context, odo IS NOT NULL AND (amount IS NOT NULL OR litres IS NOT NULL) AS mixed,
  COALESCE(odo >= 100000 AND odo = floor(odo) AND trip <> floor(trip), false) AS dropped_decimal, d IN (0, 1) AS captured, COALESCE(odo, trip, amount, litres, rate, urea) IS NULL AS nothing FROM r),
w AS (SELECT *, 0.2 * unknown_type::INT + 0.35 * odometer::INT + 0.35 * dispenser_math::INT + 0.3 * urea::INT + 0.35 * context + 0.3 * mixed::INT + 0.3 * dropped_decimal::INT + 0.25 * captured::INT + 0.4 * nothing::INT AS weight FROM f)
SELECT k, unknown_type, odometer, dispenser_math, urea, context, mixed, dropped_decimal, captured, nothing, ROUND(CAST(least(1.0, weight) AS DOUBLE), 3) AS severity,
  NOT (odometer OR dispenser_math OR urea OR context > 0 OR mixed OR dropped_decimal OR nothing) AS passed FROM w"""
)
def meter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    sold = F.col("p_size") * F.lit(90.5)
    rows = _records(
        table(spark, sf_dir, "part"),
        "meter_reading",
        reading_type=F.when(k % 5 == 0, "speedometer").when(k % 7 != 0, "odometer"),
        odometer_km=F.when(k % 4 == 0, F.lit(None)).when(k % 9 == 0, 3_500_000.0).otherwise(k * 1000.0),
        trip_km=_by(k, 3, (0, price), (1, F.lit(12.0))),
        litres=_by(k, 4, (0, F.col("p_size").cast("double"))),
        rate_per_litre=_by(k, 2, (0, F.lit(90.5))),
        amount_rs=_by(k, 8, (0, sold), (4, sold * 1.5)),
        urea_concentration_pct=_by(k, 10, (0, F.lit(120.0)), (5, F.lit(32.5))),
        captured_at=_by(k, 6, (0, F.lit("2031-01-01T10:00")), (1, F.lit("2023-02-30 08:00")), (2, F.lit(" ")), otherwise=F.lit("2023-05-01 08:00")),
    )
    return rows.select(
        k.alias("k"),
        _has("unknown_reading_type").alias("unknown_type"),
        _has("implausible_odometer").alias("odometer"),
        _has("dispenser_math_mismatch").alias("dispenser_math"),
        _has("impossible_urea_pct").alias("urea"),
        _count("dispenser_field_without_dispenser_context").alias("context"),
        _has("odometer_and_dispenser_fields_on_one_reading").alias("mixed"),
        _has("suspected_dropped_decimal").alias("dropped_decimal"),
        _has("implausible_captured_at").alias("captured"),
        _has("meter_reading_with_no_readings").alias("nothing"),
        F.col("validation.severity").alias("severity"),
        F.col("validation.passed").alias("passed"),
    )


# ---- V2, V3, V5, V7 to V9: bills ----


@query(
    """WITH r AS (SELECT c_custkey AS k, c_acctbal AS b, c_custkey % 13 = 0 AS text_items, c_custkey % 6 AS n, list_transform(range(1, 1 + c_custkey % 6), lambda i: {'q': CAST(i AS DOUBLE), 'r': c_acctbal, 'a': i * c_acctbal * (CASE WHEN (c_custkey + i) % 3 = 0 THEN 1.5 ELSE 1.0 END)}) AS lines FROM customer)
SELECT k, text_items AS not_a_list, CASE WHEN text_items THEN 0 ELSE len(list_filter(lines, lambda x: abs(x.q * x.r - x.a) > greatest(1.0, 0.02 * abs(x.a)))) END AS line_math,
  k % 4 = 0 AS gstin, k % 5 IN (0, 1) AS invoice_date, k % 11 IN (0, 1) AS vendor, (k % 7 = 0)::BIGINT + (k % 3 = 0)::BIGINT AS placeholders, k % 8 = 0 AS missing_total FROM r"""
)
def bill_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    line = lambda i: F.struct(i.cast("double").alias("qty"), b.alias("rate"), (i * b * F.when((k + i) % 3 == 0, 1.5).otherwise(1.0)).alias("amount"))
    items = F.when(k % 6 == 0, F.array().cast("array<struct<qty:double,rate:double,amount:double>>")).otherwise(F.transform(F.sequence(F.lit(1), (k % 6).cast("int")), line))
    # A field that is text in some records and an array in others is put in as JSON.
    items = F.when(k % 13 == 0, F.lit('"see attached"')).otherwise(F.to_json(items))
    rest = F.to_json(
        F.struct(
            F.when(k % 8 != 0, F.lit(100.0)).alias("total_amount"),
            _by(k, 4, (0, F.lit("27AAAPL1234C1")), (1, F.lit("27aaapl1234c1zv ")), (2, F.lit(" "))).alias("vendor_gstin"),
            _by(k, 5, (0, F.lit("2031-01-01")), (1, F.lit("2024-2-3")), (2, F.lit("2024-01-17"))).alias("invoice_date"),
            _by(k, 11, (0, F.lit(" ")), (1, F.lit(None).cast("string")), otherwise=F.lit("Seller & Sons")).alias("vendor_name"),
            _by(k, 7, (0, F.lit(" N/A"))).alias("buyer_name"),
            _by(k, 3, (0, F.lit("not legible")), (1, F.lit("KA 01"))).alias("vehicle_no"),
        )
    )
    data = F.parse_json(F.concat(F.lit('{"line_items":'), items, F.lit(","), F.substring(rest, 2, 1 << 30)))
    rows = rules.validated(table(spark, sf_dir, "customer").select("c_custkey", F.lit("vendor_bill").alias("doc_class"), data.alias("data")), AS_OF)
    return rows.select(
        k.alias("k"),
        _has("line_items_not_a_list").alias("not_a_list"),
        _count("line_math_mismatch").alias("line_math"),
        _has("malformed_gstin").alias("gstin"),
        _has("bad_invoice_date").alias("invoice_date"),
        _has("missing_vendor_name").alias("vendor"),
        _count("placeholder_value").alias("placeholders"),
        _has("missing_total_amount").alias("missing_total"),
    )


# ---- V1, V10 to V15, V25: work reports ----


@query(
    """WITH r AS (SELECT c_custkey AS k, c_custkey % 9 AS n, list_transform(range(1, 1 + c_custkey % 9), lambda i: CASE WHEN (c_custkey + i) % 11 = 0 THEN NULL WHEN (c_custkey * i) % 3 = 0 THEN '' ELSE 'Task ' || (i % 2) END) AS e FROM customer),
c AS (SELECT k, n, len(list_filter(e, lambda x: x IS NULL)) AS odd, len(list_filter(e, lambda x: x = '')) AS empty, len(list_filter(e, lambda x: x <> '')) AS told, len(list_distinct(list_filter(e, lambda x: x <> ''))) AS kinds FROM r)
SELECT k, k % 10 = 0 AS no_data, k % 10 = 1 AS not_a_list, k % 10 > 1 AND n = 0 AS no_entries, CASE WHEN k % 10 > 1 THEN odd ELSE 0 END AS no_objects,
  CASE WHEN k % 10 < 2 OR n = 0 THEN NULL WHEN empty / n >= 0.5 THEN 0.3 WHEN empty / n >= 0.25 THEN 0.15 END::DOUBLE AS missing_work,
  k % 10 > 1 AND told >= 4 AND told - kinds >= greatest(3, floor(told * 0.6)) AS repeated, k % 10 > 1 AND n > 0 AND k % 4 = 0 AS report_date FROM c"""
)
def work_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    work = lambda i: F.when((k * i) % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" task "), (i % 2).cast("string")))
    entry = lambda i: F.when((k + i) % 11 == 0, F.lit("7")).otherwise(F.to_json(F.struct(work(i).alias("work_done"), F.lit("bus").alias("bus_no"))))
    entries = F.when(k % 9 == 0, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), (k % 9).cast("long")), entry), ","))
    listed = F.concat(F.lit('{"entries":['), entries, F.lit('],"report_date":'), F.when(k % 4 == 0, F.lit('"2014-12-31"')).otherwise(F.lit('"2015-01-01"')), F.lit("}"))
    text = F.when(k % 10 == 0, F.lit("[1]")).when(k % 10 == 1, F.lit('{"entries":{},"report_date":"x"}')).otherwise(listed)
    rows = rules.validated(table(spark, sf_dir, "customer").select("c_custkey", F.lit("work_report").alias("doc_class"), F.parse_json(text).alias("data")), AS_OF)
    weight = F.try_element_at(F.filter(F.arrays_zip(F.col("validation.issues").alias("i")), lambda x: x["i"].startswith("entries_missing_work_done")), F.lit(1))["i"]
    share = F.regexp_extract(weight, ":(\\d+)/", 1).cast("double") / F.regexp_extract(weight, "/(\\d+)$", 1).cast("double")
    return rows.select(
        k.alias("k"),
        _has("no_data_object").alias("no_data"),
        _has("entries_not_a_list").alias("not_a_list"),
        _has("zero_entries_on_work_report").alias("no_entries"),
        _count("entry_not_an_object").alias("no_objects"),
        F.when(share >= 0.5, 0.3).when(share >= 0.25, 0.15).alias("missing_work"),
        _has("repeated_rows").alias("repeated"),
        _has("bad_report_date").alias("report_date"),
    )


# ---- M12, M20, R1, F4, F9, F10, A5, A7 ----


@query(
    """WITH t AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || 'abcde' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') || 'f1Z5' WHEN 1 THEN ' 27AAAPL1234C1ZV ' WHEN 2 THEN '27AAAPL1234C1Z' WHEN 3 THEN c_name END AS t FROM customer)
SELECT k, COALESCE(regexp_full_match(upper(trim(t)), '[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][0-9A-Z]{3}'), false) AS valid FROM t"""
)
def tax_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    made = F.concat(F.lpad((k % 100).cast("string"), 2, "0"), F.lit("abcde"), F.lpad(k.cast("string"), 4, "0"), F.lit("f1Z5"))
    number = _by(k, 5, (0, made), (1, F.lit(" 27AAAPL1234C1ZV ")), (2, F.lit("27AAAPL1234C1Z")), (3, F.col("c_name")))
    return table(spark, sf_dir, "customer").select(k.alias("k"), T.is_tax_number(number).alias("valid"))


@query(
    """WITH p AS (SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'meter_reading' WHEN 1 THEN 'vendor_bill' ELSE 'work_report' END AS c, 300 + p_size * 40 AS w, 200 + p_size * 31 AS h, p_size * 6.0 AS blur, p_retailprice / 10 AS bright, p_partkey % 7 = 0 AS cut FROM part),
f AS (SELECT *, list_filter(['truncated_file_recovered', CASE WHEN blur < 150 THEN 'low_sharpness' END, CASE WHEN bright < 90 THEN 'underexposed' END, CASE WHEN w * h / 1e6 < 0.15 THEN 'very_low_resolution' END], lambda x: x IS NOT NULL) AS l FROM p),
g AS (SELECT *, CASE WHEN cut THEN l ELSE l[2:] END AS flags FROM f)
SELECT k, c AS doc_class, array_to_string(flags, ';') AS flags, CASE WHEN len(flags) > 0 THEN least(CAST(floor(1568 * 1.35) AS INTEGER), 1568) ELSE 1568 END AS max_dim, 'gpt-4o' AS model,
  CASE c WHEN 'vendor_bill' THEN CAST(floor(h * 0.42) AS INTEGER) WHEN 'meter_reading' THEN CAST(floor(h * 0.88) AS INTEGER) END AS bottom, CASE c WHEN 'vendor_bill' THEN 0 WHEN 'meter_reading' THEN CAST(floor(h * 0.10) AS INTEGER) END AS top FROM g"""
)
def image_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality flags, the policy of the class, pixels to send, and the part for a second look."""
    k, size = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        k.alias("k"),
        _by(k, 3, (0, F.lit("meter_reading")), (1, F.lit("vendor_bill")), otherwise=F.lit("work_report")).alias("doc_class"),
        (300 + size * 40).alias("w"),
        (200 + size * 31).alias("h"),
        files.quality_flags(size * 6.0, F.col("p_retailprice") / 10, (300 + size * 40) * (200 + size * 31) / 1e6, k % 7 == 0).alias("flags"),
    )
    both = rows.join(F.broadcast(classes.policies(spark)), "doc_class")
    box = rules.crop_box(F.col("doc_class"), F.col("w"), F.col("h"))
    return both.select("k", "doc_class", F.array_join("flags", ";").alias("flags"), classes.resolution(F.col("max_dim"), F.col("flags")).alias("max_dim"), "model", box["bottom"].alias("bottom"), box["top"].alias("top"))


@query(
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 1 AND c_custkey % 2 = 0 THEN 'vendor_gstin' WHEN c_custkey % 3 = 0 AND c_custkey % 4 IN (1, 2) THEN 'odometer_km;trip_km;amount_rs;litres;rate_per_litre' ELSE '' END AS fields FROM customer"""
)
def reread_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    doc_class = _by(k, 3, (0, F.lit("meter_reading")), (1, F.lit("vendor_bill")), otherwise=F.lit("work_report"))
    issues = F.array_compact(F.array(F.when(k % 2 == 0, F.lit("malformed_gstin:'X'")), F.when(k % 4 == 1, F.lit("suspected_dropped_decimal:odo=1.0 trip=0.5")), F.when(k % 4 == 2, F.lit("dispenser_math_mismatch:1x2!=3"))))
    return table(spark, sf_dir, "customer").select(k.alias("k"), F.array_join(rules.reread_fields(doc_class, issues), ";").alias("fields"))


@query("SELECT COUNT(*) AS screened, COUNT(*) FILTER (html LIKE 'BM%' OR html LIKE 'GIF8%') AS passed FROM (SELECT html FROM pages UNION ALL SELECT text FROM documents)")
def screen_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = table(spark, sf_dir, "pages").select(F.col("html").cast("binary").alias("content")).unionByName(table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("content")))
    return rollups.screened(files.screened(contents).withColumn("ok", F.col("reject_reason").isNull()))


# ---- F11, J5: routes of a batch ----


@query(
    """WITH r AS (SELECT user_id % 500 AS d, event_id AS seq, event_type AS t, event_id % 4 AS k FROM events),
l AS (SELECT d, arg_max(t, seq) AS t, arg_max(k, seq) AS k FROM r GROUP BY d)
SELECT CAST(d AS VARCHAR) AS doc_id, CASE WHEN k = 3 THEN 'work_report' WHEN t = 'purchase' THEN 'vendor_bill' WHEN t IN ('view', 'click') THEN 'meter_reading' WHEN t = 'error' THEN 'not_a_document' ELSE 'work_report' END AS doc_class,
  CASE WHEN k <> 3 AND t = 'view' THEN 'odometer' WHEN k <> 3 AND t = 'click' AND k = 1 THEN 'dispenser' END AS subtype FROM l"""
)
def batch_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, k = F.col("event_type"), F.col("event_id") % 4
    named = F.when(t == "purchase", " Vendor_Bill").when(t.isin("view", "click"), "meter_reading").when(t == "error", "not_a_document").otherwise("invoice")
    sub = F.when(t == "view", "Odometer ").when(k == 1, "dispenser").otherwise("other")
    body = F.to_json(F.struct(named.alias("class"), sub.alias("subtype"), F.lit(0.7).alias("confidence")))
    responses = table(spark, sf_dir, "events").select((F.col("user_id") % 500).cast("string").alias("doc_id"), F.col("event_id").alias("seq"), F.when(k == 3, F.lit("I can not tell.")).otherwise(body).alias("text"))
    return runs.batch_routes(responses).select("doc_id", "doc_class", "subtype")


# ---- J7, J8, C1 to C3, C5, A11: scoring ----


@query(
    """WITH g AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'work_report' ELSE 'vendor_bill' END AS class FROM documents),
r AS (SELECT doc_id, quality, toxic, 0 AS seq FROM labels UNION ALL SELECT doc_id, 1 - quality, 1 - toxic, 1 FROM labels WHERE doc_id % 3 = 0),
l AS (SELECT doc_id, arg_max(quality, seq) AS quality, arg_max(toxic, seq) AS toxic FROM r GROUP BY doc_id)
SELECT g.doc_id, CASE WHEN l.doc_id IS NULL THEN 'no_result' WHEN quality = 0 THEN 'DROPPED_REAL_DOCUMENT' WHEN class = CASE WHEN toxic = 1 THEN 'vendor_bill' ELSE 'work_report' END THEN 'routed_ok' ELSE 'MISROUTED' END AS verdict FROM g LEFT JOIN l USING (doc_id)"""
)
def latest_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two results of one document the last counts."""
    gold = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", "work_report").otherwise("vendor_bill").alias("class"), F.lit("extract").alias("expect"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(0).alias("seq"))
    again = labels.filter("doc_id % 3 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"), (1 - F.col("toxic")).alias("toxic"), F.lit(1).alias("seq"))
    results = labels.unionByName(again).select(
        "doc_id",
        F.when(F.col("toxic") == 1, "vendor_bill").otherwise("work_report").alias("doc_class"),
        F.when(F.col("quality") == 0, "refused").otherwise("extracted").alias("status"),
        F.lit(None).cast("variant").alias("data"),
        "seq",
    )
    return scoring.verdicts(gold, results, "seq").select("doc_id", "verdict")


@query(
    """WITH p AS (SELECT p_partkey AS k, p_partkey % 3 AS c, p_size AS s, p_retailprice AS p FROM part WHERE p_partkey % 10 <> 0),
s AS (SELECT *, CASE c
  WHEN 0 THEN CASE WHEN k % 4 = 1 THEN 0 ELSE 1 END + CASE WHEN k % 8 = 2 THEN 0 ELSE 1 END
  WHEN 1 THEN 1 + CASE WHEN k % 4 = 1 THEN 0 ELSE 1 END + CASE WHEN s % 3 = k % 3 THEN 1 ELSE 0 END + 1 + CASE WHEN k % 8 = 3 THEN 0 ELSE 1 END
  ELSE 1 + CASE WHEN k % 4 = 1 THEN 0 ELSE 1 END + CASE WHEN abs(s % 5 - 2) <= 1 THEN 1 ELSE 0 END + CASE WHEN s % 5 >= 2 THEN 2 ELSE s % 5 END END AS good,
  CASE c WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 5 END AS due, CASE c WHEN 0 THEN 2 WHEN 1 THEN 6 ELSE 4 END AS keys FROM p)
SELECT CAST(k AS VARCHAR) AS doc_id, CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE good END AS BIGINT) AS correct, CAST(CASE WHEN k % 7 = 0 THEN keys ELSE due END AS BIGINT) AS total FROM s"""
)
def field_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of built readings, bills and reports against built gold; every seventh result has the wrong class, every tenth none."""
    k, s, p = F.col("p_partkey"), F.col("p_size").cast("long"), F.col("p_retailprice")
    rows = table(spark, sf_dir, "part").withColumn("doc_class", _by(k, 3, (0, F.lit("meter_reading")), (1, F.lit("vendor_bill")), otherwise=F.lit("work_report")))
    wrong = k % 4 == 1
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    want = {
        "meter_reading": {"reading_type": F.lit('"odometer"'), "odometer_km": p.cast("string")},
        "vendor_bill": {"vendor_name": F.lit('"Seller & Sons, Ltd."'), "total_amount": p.cast("string"), "line_item_count": (s % 3).cast("string"), "vehicle_no": F.lit('"KA-01 F 99"'), "invoice_date": F.lit('"2024-01-02"'), "line_items": F.lit("[]")},
        "work_report": {"depot": F.lit('"North Depot"'), "report_date": F.lit('"2024-01-02"'), "entry_count": F.lit("2"), "bus_codes": F.lit('["B-0","b 1","B1"]')},
    }
    gold_fields = reduce(DataFrame.unionByName, [rows.filter(F.col("doc_class") == c).select("doc_class", k.cast("string").alias("doc_id"), F.lit(f).alias("field"), w.alias("want")) for c, fields in want.items() for f, w in fields.items()])
    # bus_codes: B-0 and B1, the latter named twice; entries have the codes b0, b1 and so on.
    entries = lambda n, one: F.concat(F.lit("["), F.when(n == 0, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), n), one), ",")), F.lit("]"))
    data = {
        "meter_reading": F.concat(F.lit('{"reading_type":'), F.when(wrong, F.lit('"other"')).otherwise(F.lit('"Odometer"')), F.lit(',"odometer_km":'), F.when(k % 8 == 2, p * 2).otherwise(p).cast("string"), F.lit("}")),
        "vendor_bill": F.concat(
            F.lit('{"vendor_name":"seller sons","total_amount":'), F.when(wrong, p * 1.5).otherwise(p).cast("string"), F.lit(',"line_items":'), entries(k % 3, lambda i: F.lit("{}")),
            F.lit(',"vehicle_no":"ka01f99","invoice_date":'), F.when(k % 8 == 3, F.lit('"2024-01-03"')).otherwise(F.lit('" 2024-01-02 "')), F.lit("}"),
        ),
        "work_report": F.concat(F.lit('{"depot":"the north depot","report_date":'), F.when(wrong, F.lit("null")).otherwise(F.lit('"2024-01-02"')), F.lit(',"entries":'), entries(s % 5, lambda i: F.concat(F.lit('{"bus_no":'), text(F.concat(F.lit("B "), (i - 1).cast("string"))), F.lit("}"))), F.lit("}")),
    }
    body = reduce(lambda acc, c: F.when(F.col("doc_class") == c, data[c]).otherwise(acc), data, F.lit(None).cast("string"))
    results = rows.filter(k % 10 != 0).select(k.cast("string").alias("doc_id"), F.when(k % 7 == 0, "not_a_document").otherwise(F.col("doc_class")).alias("doc_class"), F.lit("extracted").alias("status"), F.parse_json(body).alias("data"))
    gold = rows.select(k.cast("string").alias("doc_id"), F.col("doc_class").alias("class"), F.lit("extract").alias("expect"))
    out = scoring.field_scores(scoring.verdicts(gold, results), gold_fields)
    return out.select("doc_id", F.col("correct").cast("long").alias("correct"), F.col("total").cast("long").alias("total"))


# ---- D13: what each document cost ----


@query(
    """WITH c AS (SELECT CAST(user_id AS VARCHAR) AS doc_id, COUNT(*) AS n, ROUND(CAST(SUM(CAST(json_extract_string(props, '$.k') AS DECIMAL(18, 4)) * 250 + CAST(json_extract_string(props, '$.k') AS DECIMAL(18, 4)) * 10) / 1000000 AS DOUBLE), 8) AS cost FROM events GROUP BY user_id)
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, COALESCE(n, 0) + (c_custkey % 5 = 0)::BIGINT AS n_calls, COALESCE(cost, CAST(0 AS DOUBLE)) AS cost_usd, c_custkey % 5 = 0 AS from_cache FROM customer LEFT JOIN c ON c.doc_id = CAST(c_custkey AS VARCHAR)"""
)
def document_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.get_json_object("props", "$.k").cast("long")
    cost = (tokens.cast("decimal(18,4)") * 260 / 1_000_000).cast("decimal(28,10)")
    calls = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("doc_id"), F.col("event_id").alias("seq"), F.lit("extract").alias("stage"), F.lit("gpt-4o").alias("model"),
        (tokens * 100).alias("input_tokens"), tokens.alias("output_tokens"), F.lit(0).cast("long").alias("cache_read_tokens"), cost.alias("cost_usd"),
    )
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), "c_custkey")
    out = runs.with_provenance(docs, calls, docs.filter("c_custkey % 5 = 0"))
    last = F.try_element_at("provenance.stages", F.lit(-1))
    return out.select("doc_id", F.size("provenance.calls").cast("long").alias("n_calls"), "provenance.cost_usd", F.coalesce(last == "cache", F.lit(False)).alias("from_cache"))


# ---- M2 on variants ----


@query(
    """SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN c_acctbal WHEN 1 THEN CAST(c_custkey AS DOUBLE) * 1000 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 0.2 ELSE NULL END::DOUBLE AS number FROM customer"""
)
def variant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    body = _by(k, 6, (0, F.col("c_acctbal").cast("string")), (1, F.concat(F.lit('"Rs '), k.cast("string"), F.lit(',000"'))), (2, F.lit("true")), (3, F.lit("null")), (4, F.lit('"Rs. 200"')), otherwise=F.lit('"1.2.3"'))
    return table(spark, sf_dir, "customer").select(k.alias("k"), number_from_variant(F.parse_json(body)).alias("number"))
