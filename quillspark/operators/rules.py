"""Validation rules as expressions: an array of (issue, weight) per record, then pass, issues and severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.numbers import number_from_variant, quoted, shown
from ..functions.text import is_placeholder, is_recent_date, is_tax_number

ISSUE = "struct<issue:string,weight:double>"
READING_TYPES = ["odometer", "def_dispenser", "fuel_dispenser", "other"]
READINGS = ["odometer_km", "trip_km", "amount_rs", "litres", "rate_per_litre", "urea_concentration_pct"]


def _get(data: Column, path: str) -> Column:
    return F.try_variant_get(data, path, "variant")


def _text(data: Column, path: str) -> Column:
    """The string at path; null if it is anything else."""
    value = _get(data, path)
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _number(data: Column, path: str) -> Column:
    return number_from_variant(_get(data, path))


def _kind(data: Column, path: str) -> Column:
    """OBJECT, ARRAY, STRING and so on; VOID for null and absent."""
    return F.regexp_extract(F.coalesce(F.schema_of_variant(_get(data, path)), F.lit("VOID")), "^[A-Z]+", 0)


def _object(value: Column) -> Column:
    """An object variant as a map; null if it is none. Cheaper than its schema, which walks through all of it."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _present(data: Column, path: str) -> Column:
    return _kind(data, path) != "VOID"


def _shown_value(data: Column, path: str) -> Column:
    """A value as issues show it."""
    raw = F.to_json(_get(data, path))
    return F.coalesce(quoted(_text(data, path)), raw)


def issue(text: Column | str, weight: float) -> Column:
    return F.struct((F.lit(text) if isinstance(text, str) else text).alias("issue"), F.lit(weight).alias("weight"))


def some(*issues: Column) -> Column:
    return F.array_compact(F.array(*issues))


def _list(data: Column, path: str) -> Column:
    """An array variant as an array of variants; null if it is none."""
    return F.try_variant_get(data, path, "array<variant>")


def _rows(data: Column, path: str) -> Column:
    """An array variant as an array of variants, empty where it is no array."""
    return F.coalesce(_list(data, path), F.array().cast("array<variant>"))


def placeholder_issues(data: Column) -> Column:
    """One per top-level key whose text stands for nothing."""
    fields = F.transform(
        F.map_entries(_object(data)),
        lambda e: F.struct(e["key"].alias("key"), F.when(F.schema_of_variant(e["value"]) == "STRING", F.try_variant_get(e["value"], "$", "string")).alias("text")),
    )
    return F.transform(F.filter(fields, lambda e: is_placeholder(e["text"])), lambda e: issue(F.concat(F.lit("placeholder_value:"), e["key"], F.lit("="), quoted(e["text"])), 0.25))


def read_bill(data: Column) -> Column:
    """What the rules for bills look at, as one typed value; a view to be kept beside the variant and read instead of it."""
    # Falsy values count as no items; anything else that is no array is a fault.
    falsy = F.to_json(_get(data, "$.line_items")).isin("0", "0.0", '""', "false", "{}")
    not_list = F.when(_list(data, "$.line_items").isNotNull(), False).otherwise((_kind(data, "$.line_items") != "VOID") & ~F.coalesce(falsy, F.lit(False)))
    lines = F.transform(
        F.filter(_rows(data, "$.line_items"), lambda r: _object(r).isNotNull()),
        lambda r: F.struct(_number(r, "$.qty").alias("qty"), _number(r, "$.rate").alias("rate"), _number(r, "$.amount").alias("amount")),
    )
    return F.struct(
        not_list.alias("not_list"),
        lines.alias("lines"),
        _number(data, "$.total_amount").alias("total"),
        F.coalesce(_number(data, "$.tax_amount"), F.lit(0.0)).alias("tax"),
        _text(data, "$.vendor_gstin").alias("gstin"),
        _text(data, "$.vendor_name").alias("vendor"),
        _present(data, "$.invoice_date").alias("dated"),
        _text(data, "$.invoice_date").alias("date"),
        _shown_value(data, "$.invoice_date").alias("date_shown"),
    )


def bill_view(lines: Column, total: Column, tax: Column | None = None, gstin: Column | None = None, vendor: Column | None = None, date: Column | None = None) -> Column:
    """read_bill() of a bill whose fields are typed columns: lines an array of (qty, rate, amount) structs, total and tax doubles, the rest texts."""
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    blank = F.array().cast("array<struct<qty:double,rate:double,amount:double>>")
    dated = F.coalesce(text(date) != "", F.lit(False))
    return F.struct(
        F.lit(False).alias("not_list"),
        F.coalesce(lines, blank).alias("lines"),
        total.cast("double").alias("total"),
        F.coalesce(F.lit(0.0) if tax is None else tax.cast("double"), F.lit(0.0)).alias("tax"),
        text(gstin).alias("gstin"),
        text(vendor).alias("vendor"),
        dated.alias("dated"),
        text(date).alias("date"),
        quoted(text(date)).alias("date_shown"),
    )


def bill_rules(read: Column, as_of: Column) -> Column:
    """The issues of a bill, from read_bill() or bill_view()."""

    def sums(x: Column) -> Column:
        amounts = F.filter(F.transform(x["lines"], lambda i: i["amount"]), lambda i: i.isNotNull())
        return F.struct(F.size(amounts).alias("n"), F.aggregate(amounts, F.lit(0.0), lambda a, i: a + i).alias("sum"))

    def issues(x: Column) -> Column:
        total, tax, gstin, vendor = x["total"], x["tax"], x["gstin"], x["vendor"]
        wrong = F.filter(x["lines"], lambda i: F.abs(i["qty"] * i["rate"] - i["amount"]) > F.greatest(F.lit(1.0), 0.02 * F.abs(i["amount"])))

        def off(s: Column) -> Column:
            far = F.least(F.abs(s["sum"] - total), F.abs(s["sum"] + tax - total)) > F.greatest(F.lit(2.0), 0.03 * total)
            return F.when((s["n"] > 0) & (s["sum"] > 0) & far, issue(F.concat(F.lit("total_mismatch:lines="), shown(F.round(s["sum"], 2)), F.lit(" tax="), shown(tax), F.lit(" total="), shown(total)), 0.35))

        return F.concat(
            some(
                F.when(x["not_list"], issue("line_items_not_a_list", 0.4)),
                F.when(total.isNull(), issue("missing_total_amount", 0.3))
                .when(total <= 0, issue(F.concat(F.lit("non_positive_total:"), shown(total)), 0.3))
                .when(total > 5_000_000, issue(F.concat(F.lit("implausible_total:"), shown(total)), 0.25)),
            ),
            F.transform(wrong, lambda i: issue(F.concat(F.lit("line_math_mismatch:"), shown(i["qty"]), F.lit("x"), shown(i["rate"]), F.lit("!="), shown(i["amount"])), 0.15)),
            some(
                let(sums(x), off),
                F.when((F.trim(gstin) != "") & ~is_tax_number(gstin), issue(F.concat(F.lit("malformed_gstin:"), quoted(gstin)), 0.1)),
                F.when(x["dated"] & ~is_recent_date(x["date"], as_of), issue(F.concat(F.lit("bad_invoice_date:"), x["date_shown"]), 0.2)),
                F.when(vendor.isNull() | (F.trim(vendor) == ""), issue("missing_vendor_name", 0.15)),
            ),
        )

    return let(read, issues)


def bill_issues(data: Column, as_of: Column) -> Column:
    return bill_rules(read_bill(data), as_of)


def repeat_issue(texts: Column) -> Column:
    """Many rows of which most repeat."""

    def one(c: Column) -> Column:
        limit = F.greatest(F.lit(3), F.floor(c["n"] * 0.6).cast("int"))
        text = F.concat(F.lit("repeated_rows:"), c["again"].cast("string"), F.lit("/"), c["n"].cast("string"))
        return F.when((c["n"] >= 4) & (c["again"] >= limit), issue(text, 0.3))

    return let(F.struct(F.size(texts).alias("n"), (F.size(texts) - F.size(F.array_distinct(texts))).alias("again")), one)


def work_issues(data: Column, as_of: Column) -> Column:
    is_object = lambda r: F.coalesce(_object(r).isNotNull(), F.lit(False))
    read = F.struct(
        _list(data, "$.entries").isNotNull().alias("listed"),
        F.transform(_rows(data, "$.entries"), lambda r: F.struct(is_object(r).alias("is_object"), F.when(is_object(r), _text(r, "$.work_done")).alias("work"))).alias("rows"),
        _present(data, "$.report_date").alias("dated"),
        _text(data, "$.report_date").alias("date"),
        _shown_value(data, "$.report_date").alias("date_shown"),
    )

    def missing(s: Column) -> Column:
        text = F.concat(F.lit("entries_missing_work_done:"), s["empty"].cast("string"), F.lit("/"), s["n"].cast("string"))
        return F.when(s["empty"] / s["n"] >= 0.5, issue(text, 0.3)).when(s["empty"] / s["n"] >= 0.25, issue(text, 0.15))

    def issues(x: Column) -> Column:
        rows = x["rows"]
        empty = F.size(F.filter(rows, lambda r: r["is_object"] & F.coalesce(F.trim(r["work"]) == "", F.lit(True))))
        texts = F.transform(F.filter(rows, lambda r: F.coalesce(r["work"] != "", F.lit(False))), lambda r: F.lower(F.trim(r["work"])))
        found = F.concat(
            F.transform(F.filter(rows, lambda r: ~r["is_object"]), lambda r: issue("entry_not_an_object", 0.2)),
            some(
                let(F.struct(empty.alias("empty"), F.greatest(F.size(rows), F.lit(1)).alias("n")), missing),
                let(texts, repeat_issue),
                F.when(x["dated"] & ~is_recent_date(x["date"], as_of), issue(F.concat(F.lit("bad_report_date:"), x["date_shown"]), 0.2)),
            ),
        )
        return F.when(~x["listed"], some(issue("entries_not_a_list", 0.5))).when(F.size(rows) == 0, some(issue("zero_entries_on_work_report", 0.2))).otherwise(found)

    return let(read, issues)


def meter_issues(data: Column, as_of: Column) -> Column:
    read = F.struct(
        *[_number(data, f"$.{name}").alias(name) for name in READINGS],
        _present(data, "$.reading_type").alias("typed"),
        _text(data, "$.reading_type").alias("type"),
        _shown_value(data, "$.reading_type").alias("type_shown"),
        _text(data, "$.captured_at").alias("taken"),
    )

    def issues(x: Column) -> Column:
        odo, trip, amount, litres, rate, urea = (x[c] for c in READINGS)
        both = F.concat(F.lit("suspected_dropped_decimal:odo="), shown(odo), F.lit(" trip="), shown(trip))
        dispensed = amount.isNotNull() | litres.isNotNull()
        alone = [F.when(x[c].isNotNull() & ~dispensed, issue(f"dispenser_field_without_dispenser_context:{c}", 0.35)) for c in ("rate_per_litre", "urea_concentration_pct")]
        nothing = F.coalesce(*[x[c] for c in READINGS]).isNull()
        return some(
            F.when(x["typed"] & ~F.coalesce(x["type"].isin(READING_TYPES), F.lit(False)), issue(F.concat(F.lit("unknown_reading_type:"), x["type_shown"]), 0.2)),
            F.when(~odo.between(0, 3_000_000), issue(F.concat(F.lit("implausible_odometer:"), shown(odo)), 0.35)),
            F.when((litres > 0) & (F.abs(litres * rate - amount) > F.greatest(F.lit(2.0), 0.03 * amount)), issue(F.concat(F.lit("dispenser_math_mismatch:"), shown(litres), F.lit("x"), shown(rate), F.lit("!="), shown(amount)), 0.35)),
            F.when(~urea.between(0, 100), issue(F.concat(F.lit("impossible_urea_pct:"), shown(urea)), 0.3)),
            *alone,
            F.when(odo.isNotNull() & dispensed, issue("odometer_and_dispenser_fields_on_one_reading", 0.3)),
            F.when((odo == F.floor(odo)) & (trip != F.floor(trip)) & (odo >= 100_000), issue(both, 0.3)),
            F.when((F.trim(x["taken"]) != "") & ~is_recent_date(F.left(F.trim(x["taken"]), F.lit(10)), as_of), issue(F.concat(F.lit("implausible_captured_at:"), quoted(x["taken"])), 0.25)),
            F.when(nothing, issue("meter_reading_with_no_readings", 0.4)),
        )

    return let(read, issues)


def fold(issues: Column) -> Column:
    """passed, issues and severity: weights add up to 1 at most; one of 0.3 or more fails the record."""

    def one(found: Column) -> Column:
        severity = F.aggregate(found, F.lit(0.0), lambda s, x: F.least(F.lit(1.0), s + x["weight"]))
        return F.struct((~F.exists(found, lambda x: x["weight"] >= 0.3)).alias("passed"), F.transform(found, lambda x: x["issue"]).alias("issues"), F.round(severity, 3).alias("severity"))

    return let(issues, one)


def validated(records: DataFrame, as_of: str, class_col: str = "doc_class", data_col: str = "data", out_col: str = "validation") -> DataFrame:
    """records with their validation. Data that is null or no object has one issue; unknown classes get the placeholder rule alone."""
    data, day = F.col(data_col), F.lit(as_of).cast("date")
    none = F.array().cast(f"array<{ISSUE}>")
    by_class = F.when(F.col(class_col) == "vendor_bill", bill_issues(data, day)).when(F.col(class_col) == "work_report", work_issues(data, day)).when(F.col(class_col) == "meter_reading", meter_issues(data, day)).otherwise(none)
    issues = F.when(_object(data).isNotNull(), F.concat(placeholder_issues(data), by_class)).otherwise(some(issue("no_data_object", 0.5)))
    return records.withColumn(out_col, fold(issues))


def validated_bills(bills: DataFrame, as_of: str, view_col: str = "bill", out_col: str = "validation") -> DataFrame:
    """validated() of bills with a typed view (read_bill() or bill_view()): columns are read and no variant is walked.

    The placeholder rule looks at the view's texts.
    """
    x, day = F.col(view_col), F.lit(as_of).cast("date")
    told = [F.when(is_placeholder(x[f]), issue(F.concat(F.lit(f"placeholder_value:{name}="), quoted(x[f])), 0.25)) for f, name in (("date", "invoice_date"), ("gstin", "vendor_gstin"), ("vendor", "vendor_name"))]
    return bills.withColumn(out_col, fold(F.concat(some(*told), bill_rules(x, day))))


def effective_confidence(confidence: Column, severity: Column) -> Column:
    """Confidence, at most 1, less the severity up to 0.6; not below 0."""
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence) - F.least(severity, F.lit(0.6))), 3)


def reread_fields(doc_class: Column, issues: Column) -> Column:
    """Fields worth a second look at a crop, by what failed."""
    text = F.array_join(issues, " ")
    meter = text.contains("suspected_dropped_decimal") | text.contains("dispenser_math_mismatch")
    return F.when((doc_class == "vendor_bill") & text.contains("malformed_gstin"), F.array(F.lit("vendor_gstin"))).when((doc_class == "meter_reading") & meter, F.array(*map(F.lit, READINGS[:5]))).otherwise(F.array().cast("array<string>"))


def crop_box(doc_class: Column, width: Column, height: Column) -> Column:
    """The part of the image to look at again: the head of a bill, the middle of a display; null elsewhere."""
    box = lambda x0, y0, x1, y1: F.struct(F.lit(x0).alias("left"), y0.cast("int").alias("top"), x1.alias("right"), y1.cast("int").alias("bottom"))
    return F.when(doc_class == "vendor_bill", box(0, F.lit(0), width, F.greatest(F.lit(1), F.floor(height * 0.42)))).when(doc_class == "meter_reading", box(0, F.floor(height * 0.10), width, F.floor(height * 0.88)))
