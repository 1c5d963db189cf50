"""Accuracy against gold labels: verdict per document, field scores, and one row of counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import number_from_variant, numbers_match
from ..functions.text import norm_code, norm_text, texts_match
from .rollups import written_with


def _get(data: Column, path: str) -> Column:
    return F.try_variant_get(data, path, "variant")


def _string(value: Column) -> Column:
    """A scalar variant as text; null for null."""
    return F.when(F.schema_of_variant(value) != "VOID", F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))


def _truthy(data: Column) -> Column:
    return F.coalesce(~F.to_json(data).isin("null", "{}", "[]", '""', "0", "false"), F.lit(False))


def latest(results: DataFrame, order_col: str | None = None) -> DataFrame:
    """One result per document: the last by order_col, or any where rows don't repeat."""
    if order_col is None:
        return results
    cols = [c for c in results.columns if c != "doc_id"]
    return results.groupBy("doc_id").agg(F.max_by(F.struct(*cols), order_col).alias("r")).select("doc_id", "r.*")


def verdicts(gold: DataFrame, results: DataFrame, order_col: str | None = None) -> DataFrame:
    """doc_id, class, expect, got_class, status, verdict per gold row. results: doc_id, doc_class, status, data (variant).

    A gold row without a result is no_result and counts nowhere. Of several results of a document the
    last by order_col counts.
    """
    r = latest(results, order_col).select("doc_id", F.col("doc_class").alias("got_class"), "status", "data")
    refused = F.col("status") == "refused"
    known = F.col("found").isNotNull()
    refuse = F.col("expect") == "refuse"
    verdict = (
        F.when(~known, "no_result")
        .when(refuse & refused, "correctly_refused")
        .when(refuse & _truthy(F.col("data")), "HALLUCINATED")
        .when(refuse, "not_refused_but_empty")
        .when(refused, "DROPPED_REAL_DOCUMENT")
        .when(F.col("got_class") == F.col("class"), "routed_ok")
        .otherwise("MISROUTED")
    )
    return gold.join(r.withColumn("found", F.lit(True)), "doc_id", "left").withColumn("verdict", F.coalesce(verdict, F.lit("MISROUTED"))).drop("found")


def _size(value: Column) -> Column:
    """Length of an array variant; null for anything else."""
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), F.size(F.from_json(F.to_json(value), "array<variant>")))


def field_scores(judged: DataFrame, field_gold: DataFrame) -> DataFrame:
    """doc_id, correct and total per document with field gold. judged is verdicts()' output; field_gold is doc_class, doc_id, field, want (JSON text).

    Where the class is wrong or there is no data, the total is the count of gold keys, which differs
    from the total of a scored document.
    """
    due = judged.filter("verdict <> 'no_result' and expect <> 'refuse'").select("doc_id", F.col("class").alias("doc_class"), "got_class", "data")
    rows = due.join(field_gold, ["doc_class", "doc_id"])
    want = F.try_parse_json("want")
    usable = F.coalesce((F.col("got_class") == F.col("doc_class")) & F.schema_of_variant("data").startswith("OBJECT"), F.lit(False))
    fields = F.from_json(F.to_json("data"), "map<string,variant>")
    got = F.try_element_at(fields, F.col("field"))
    number = numbers_match(number_from_variant(got), number_from_variant(want))
    text = texts_match(_string(got), _string(want))
    date = F.trim(F.coalesce(_string(got), F.lit(""))) == F.coalesce(_string(want), F.lit(""))
    f = F.col("field")

    meter = F.when(f == "reading_type", text).otherwise(number)
    lines = F.coalesce(_size(F.try_element_at(fields, F.lit("line_items"))), F.lit(0))
    bill = (
        F.when(f == "line_item_count", lines == F.try_variant_get(want, "$", "int"))
        .when(f == "vehicle_no", norm_code(_string(got)) == norm_code(_string(want)))
        .when(f.isin("total_amount", "tax_amount"), number)
        .when(f == "invoice_date", date)
        .otherwise(text)
    )
    entries = F.try_element_at(fields, F.lit("entries"))
    codes = lambda texts: F.array_distinct(F.filter(F.transform(texts, norm_code), lambda c: c != ""))
    got_codes = codes(F.from_json(F.to_json(F.transform(F.from_json(F.to_json(entries), "array<struct<bus_no:string>>"), lambda e: e["bus_no"])), "array<string>"))
    want_codes = codes(F.from_json("want", "array<string>"))
    count_near = F.abs(F.coalesce(_size(entries), F.lit(0)) - F.try_variant_get(want, "$", "int")) <= 1
    work = F.when(f == "depot", text).when(f == "report_date", date).when(f == "entry_count", count_near)

    hits = F.size(F.array_intersect(F.coalesce(want_codes, F.array().cast("array<string>")), F.coalesce(got_codes, F.array().cast("array<string>"))))
    one = lambda good: F.coalesce(good, F.lit(False)).cast("int")
    is_codes = (F.col("doc_class") == "work_report") & (f == "bus_codes")
    counted = ~((F.col("doc_class") == "vendor_bill") & (f == "line_items"))
    known = (F.col("doc_class") != "work_report") | f.isin("depot", "report_date", "entry_count", "bus_codes")
    correct = F.when(is_codes, hits).when(F.col("doc_class") == "meter_reading", one(meter)).when(F.col("doc_class") == "vendor_bill", one(bill)).otherwise(one(work))
    total = F.when(is_codes, F.size(F.coalesce(want_codes, F.array().cast("array<string>")))).otherwise(1)
    scored = rows.select(
        "doc_id",
        usable.alias("usable"),
        F.when(usable & counted & known, correct).otherwise(0).alias("correct"),
        F.when(usable, F.when(counted & known, total).otherwise(0)).otherwise(1).alias("total"),
    )
    return scored.groupBy("doc_id").agg(F.sum("correct").alias("correct"), F.sum("total").alias("total"))


#: What the lists of listed() hold: by verdict, and whether the gold row is a duplicate.
LISTS = {
    "hallucinated_docs": lambda v, dup: v == "HALLUCINATED",
    "dropped_real_documents": lambda v, dup: v == "DROPPED_REAL_DOCUMENT",
    "misrouted": lambda v, dup: v == "MISROUTED",
    "dedup_detected": lambda v, dup: dup & (v == "correctly_refused"),
    "dedup_missed": lambda v, dup: dup & v.isin("HALLUCINATED", "not_refused_but_empty"),
}


def _counters() -> dict[str, Column]:
    v = F.col("verdict")
    return {
        "routing_correct": F.count_if(v == "routed_ok"),
        "routing_total": F.count_if(v.isin("DROPPED_REAL_DOCUMENT", "routed_ok", "MISROUTED")),
        "refusal_correct": F.count_if(v == "correctly_refused"),
        "refusal_total": F.count_if(v.isin("correctly_refused", "HALLUCINATED", "not_refused_but_empty")),
        "hallucination_count": F.count_if(v == "HALLUCINATED"),
    }


def _share(a: str, b: str) -> Column:
    return F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 4)


def listed(judged: DataFrame) -> DataFrame:
    """list and doc_id: one row for each document on one of LISTS, as a table of any length. judged is verdicts()' output."""
    dup = F.col("duplicate_of").isNotNull() if "duplicate_of" in judged.columns else F.lit(False)
    on = F.array_compact(F.array(*[F.when(cond(F.col("verdict"), dup), F.lit(name)) for name, cond in LISTS.items()]))
    return judged.select(F.explode(on).alias("list"), "doc_id")


def score(gold: DataFrame, results: DataFrame, field_gold: DataFrame | None = None, order_col: str | None = None) -> DataFrame:
    """One row of counters and ratios to four places (null of none); listed() gives the documents behind them.

    Routing, refusal and field accuracy stay apart, and hallucinations are listed: an average would hide them.
    """
    judged = verdicts(gold, results, order_col)
    out = judged.agg(*[c.alias(name) for name, c in _counters().items()])
    out = out.withColumns({"routing_accuracy": _share("routing_correct", "routing_total"), "refusal_accuracy": _share("refusal_correct", "refusal_total"), "k": F.lit(1)})
    if field_gold is None:
        return out.drop("k")
    fields = field_scores(judged, field_gold).agg(F.coalesce(F.sum("correct"), F.lit(0)).alias("field_correct"), F.coalesce(F.sum("total"), F.lit(0)).alias("field_total"), F.lit(1).alias("k"))
    return out.join(fields, "k").withColumn("field_accuracy", _share("field_correct", "field_total")).drop("k")


def score_while_written(gold: DataFrame, results: DataFrame, path: str, order_col: str | None = None) -> dict[str, int]:
    """Write verdicts() to path; the counters of score() come from the same pass."""
    return written_with(verdicts(gold, results, order_col).drop("data"), path, _counters())


def set_overlap(a: Column, b: Column) -> Column:
    """hit and missing: what of the distinct values of a is in b, and what is not, sorted."""
    return F.struct(F.sort_array(F.array_intersect(F.array_distinct(a), b)).alias("hit"), F.sort_array(F.array_except(F.array_distinct(a), b)).alias("missing"))


def words(text: Column) -> Column:
    """Words of the normal form of a text."""
    return F.filter(F.split(norm_text(text), " "), lambda w: w != "")
