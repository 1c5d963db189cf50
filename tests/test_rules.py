import json
import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import rules


def check(spark, doc_class, data):
    df = spark.createDataFrame([(doc_class, json.dumps(data) if data is not None else None)], "doc_class string, raw string")
    out = rules.validated(df.withColumn("data", F.parse_json("raw")), "2024-03-10").select("validation").first().validation
    return out.issues, out.severity, out.passed


BILL = {"vendor_name": "Some Shop", "invoice_date": "2024-03-01", "total_amount": 300, "tax_amount": 0, "line_items": [{"qty": 2, "rate": 50, "amount": 100}, {"qty": 1, "rate": "200", "amount": "Rs 200"}]}
METER = {"reading_type": "odometer", "odometer_km": 51234.5, "trip_km": 10.2}
WORK = {"report_date": "2024-03-01", "entries": [{"work_done": f"job {k}"} for k in range(6)]}

BILLS = [
    ({}, [], 0.0),
    ({"total_amount": None}, ["missing_total_amount"], 0.3),
    ({"total_amount": -1}, ["non_positive_total:-1.0", "total_mismatch:lines=300.0 tax=0.0 total=-1.0"], 0.65),
    ({"total_amount": 330}, ["total_mismatch:lines=300.0 tax=0.0 total=330.0"], 0.35),
    ({"total_amount": 330, "tax_amount": 30}, [], 0.0),
    ({"line_items": "none at all"}, ["line_items_not_a_list"], 0.4),
    ({"line_items": [{"qty": 2, "rate": 50, "amount": 300}]}, ["line_math_mismatch:2.0x50.0!=300.0"], 0.15),
    ({"vendor_gstin": "abc123"}, ["malformed_gstin:'abc123'"], 0.1),
    ({"invoice_date": "2024-13-01"}, ["bad_invoice_date:'2024-13-01'"], 0.2),
    ({"vendor_name": "  "}, ["missing_vendor_name"], 0.15),
    ({"vendor_name": "N/A"}, ["placeholder_value:vendor_name='N/A'"], 0.25),
    ({"buyer_name": 123456}, [], 0.0),
]


@pytest.mark.parametrize(("change", "issues", "severity"), BILLS)
def test_bills(spark, change, issues, severity):
    got, weight, passed = check(spark, "vendor_bill", BILL | change)
    assert (got, weight) == (issues, pytest.approx(severity))
    assert passed == (not any(i.split(":")[0] in ("missing_total_amount", "non_positive_total", "total_mismatch", "line_items_not_a_list") for i in issues))


def test_implausible_total(spark):
    assert check(spark, "vendor_bill", {"vendor_name": "x y", "total_amount": 6_000_000})[0] == ["implausible_total:6000000.0"]


WORKS = [
    ({}, [], 0.0),
    ({"entries": "x"}, ["entries_not_a_list"], 0.5),
    ({"entries": []}, ["zero_entries_on_work_report"], 0.2),
    ({"entries": [{"work_done": "a"}, 5]}, ["entry_not_an_object"], 0.2),
    ({"entries": [{"work_done": "a"}, {"work_done": " "}]}, ["entries_missing_work_done:1/2"], 0.3),
    ({"entries": [{"work_done": c} for c in "abc"] + [{}]}, ["entries_missing_work_done:1/4"], 0.15),
    ({"entries": [{"work_done": "same"}] * 4}, ["repeated_rows:3/4"], 0.3),
    ({"entries": [{"work_done": "same"}] * 3}, [], 0.0),
    ({"report_date": "1999-01-01"}, ["bad_report_date:'1999-01-01'"], 0.2),
]


@pytest.mark.parametrize(("change", "issues", "severity"), WORKS)
def test_work_reports(spark, change, issues, severity):
    got, weight, _ = check(spark, "work_report", WORK | change)
    assert (got, weight) == (issues, pytest.approx(severity))


METERS = [
    ({}, []),
    ({"reading_type": "clock"}, ["unknown_reading_type:'clock'"]),
    ({"odometer_km": 4e6}, ["implausible_odometer:4000000.0", "suspected_dropped_decimal:odo=4000000.0 trip=10.2"]),
    ({"odometer_km": None, "trip_km": None, "amount_rs": 100, "litres": 10, "rate_per_litre": 20}, ["dispenser_math_mismatch:10.0x20.0!=100.0"]),
    ({"odometer_km": None, "amount_rs": 10, "urea_concentration_pct": 120}, ["impossible_urea_pct:120.0"]),
    ({"rate_per_litre": 3.4}, ["dispenser_field_without_dispenser_context:rate_per_litre"]),
    ({"litres": 5}, ["odometer_and_dispenser_fields_on_one_reading"]),
    ({"odometer_km": 512345}, ["suspected_dropped_decimal:odo=512345.0 trip=10.2"]),
    ({"captured_at": "1970-01-01 10:00"}, ["implausible_captured_at:'1970-01-01 10:00'"]),
    ({"odometer_km": None, "trip_km": None}, ["meter_reading_with_no_readings"]),
]


@pytest.mark.parametrize(("change", "issues"), METERS)
def test_meters(spark, change, issues):
    assert check(spark, "meter_reading", METER | change)[0] == issues


def test_no_data_and_other_classes(spark):
    assert check(spark, "vendor_bill", None) == (["no_data_object"], 0.5, False)
    assert check(spark, "vendor_bill", [1]) == (["no_data_object"], 0.5, False)
    assert check(spark, "letter", {"x": "unknown"}) == (["placeholder_value:x='unknown'"], 0.25, True)


def test_confidence_and_reread(spark):
    df = spark.createDataFrame([(1.4, 0.0, 1.0), (0.9, 0.9, 0.3), (0.5, 1.0, 0.0)], "c double, s double, want double")
    assert all(r.got == pytest.approx(r.want) for r in df.withColumn("got", rules.effective_confidence(F.col("c"), F.col("s"))).collect())
    row = spark.range(1).select(
        rules.reread_fields(F.lit("vendor_bill"), F.array(F.lit("malformed_gstin:'x'"))).alias("a"),
        rules.reread_fields(F.lit("work_report"), F.array(F.lit("malformed_gstin:'x'"))).alias("b"),
        rules.crop_box(F.lit("vendor_bill"), F.lit(100), F.lit(200)).alias("c"),
        rules.crop_box(F.lit("work_report"), F.lit(100), F.lit(200)).alias("d"),
    ).first()
    assert (row.a, row.b, tuple(row.c), row.d) == (["vendor_gstin"], [], (0, 0, 100, 84), None)


def test_typed_views_of_bills_say_what_variants_say(spark):
    """Both views of the same bills, the one read from a variant and the one of columns, have the issues of the variant."""
    rnd = random.Random(4)
    kind = "total_amount double, tax_amount double, vendor_gstin string, vendor_name string, invoice_date string, line_items array<struct<qty:double,rate:double,amount:double>>"
    pick = lambda *some: rnd.choice(some)
    rows = [
        (pick(None, -1.0, 100.0, 106.0, 6e6), pick(None, 6.0), pick(None, "bad", "27AAPFU0939F1ZV", "n/a"), pick(None, " ", "Shop", "test"), pick(None, "2024-03-01", "2031-01-01", "soon"), [(pick(None, 1.0, 2.0), pick(None, 50.0), pick(None, 50.0, 100.0)) for _ in range(rnd.randint(0, 3))])
        for _ in range(150)
    ]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], f"k int, b struct<{', '.join(c.replace(' ', ':', 1) for c in kind.split(', '))}>")
    df = df.select("k", F.lit("vendor_bill").alias("doc_class"), F.parse_json(F.to_json("b")).alias("data"), "b")
    whole = rules.validated(df, "2024-03-10")
    view = rules.bill_view(F.col("b.line_items"), F.col("b.total_amount"), F.col("b.tax_amount"), F.col("b.vendor_gstin"), F.col("b.vendor_name"), F.col("b.invoice_date"))
    both = whole.withColumns({"typed": view, "read": rules.read_bill(F.col("data"))})
    out = rules.validated_bills(rules.validated_bills(both, "2024-03-10", "typed", "by_columns"), "2024-03-10", "read", "by_view")
    for r in out.select("k", "validation", "by_columns", "by_view").collect():
        want = (r.validation.passed, sorted(r.validation.issues), r.validation.severity)
        assert (r.by_view.passed, sorted(r.by_view.issues), r.by_view.severity) == want
        assert (r.by_columns.passed, sorted(r.by_columns.issues), r.by_columns.severity) == want
