"""Document classes: fields, policies and the prompts made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = ["work_report", "vendor_bill", "meter_reading", "not_a_document"]

# Fields by class as (name, type, required), columns of positional rows, subtype masks.
FIELDS = {
    "work_report": [("depot", "string|null", False), ("report_date", "date|null", True), ("entries", "array<work_entry>", True), ("page_label", "string|null", False)],
    "vendor_bill": [
        ("vendor_name", "string|null", True), ("vendor_gstin", "string|null", False), ("vendor_phone", "string|null", False), ("invoice_no", "string|null", True),
        ("invoice_date", "date|null", True), ("buyer_name", "string|null", False), ("vehicle_no", "string|null", False), ("line_items", "array<line_item>", True),
        ("subtotal", "number|null", False), ("tax_amount", "number|null", False), ("total_amount", "number|null", True), ("amount_in_words", "string|null", False), ("currency", "string", False),
    ],
    "meter_reading": [
        ("reading_type", "enum", True), ("odometer_km", "number|null", False), ("trip_km", "number|null", False), ("fuel_level_pct", "number|null", False), ("amount_rs", "number|null", False),
        ("litres", "number|null", False), ("rate_per_litre", "number|null", False), ("urea_concentration_pct", "number|null", False), ("vehicle_no", "string|null", False), ("captured_at", "datetime|null", False),
    ],
}
ROW_COLUMNS = {"entries": ["sr_no", "mechanic", "bus_no", "work_done", "material", "struck_through"], "line_items": ["description", "hsn", "qty", "rate", "amount"]}
SUBTYPES = {
    "odometer": ["reading_type", "odometer_km", "trip_km", "fuel_level_pct", "vehicle_no", "captured_at"],
    "dispenser": ["reading_type", "amount_rs", "litres", "rate_per_litre", "urea_concentration_pct", "vehicle_no", "captured_at"],
}
POLICIES = [("meter_reading", "gpt-4o", 1568, 92, 400), ("vendor_bill", "gpt-4o", 1568, 92, 1600), ("work_report", "gpt-4o", 1568, 92, 3000)]
ROUTER = ("gpt-4o-mini", 384, 70)
MOST_PIXELS, BOOST = 1568, 1.35


#: What to look out for in each class, and what a quality flag means for reading.
HINTS = {
    "work_report": "One entry per written line of work; lines struck through are entries too, and marked so.",
    "vendor_bill": "Amounts as printed, without currency signs; the total is the sum to be paid, taxes included.",
    "meter_reading": "Digits of the display alone, with the decimal point where the display has one; null for what it does not show.",
}
QUALITY_NOTES = {
    "truncated_file_recovered": "The lower part of the image may be missing.",
    "low_sharpness": "The image is blurred: give null rather than a guess.",
    "underexposed": "The image is dark.",
    "very_low_resolution": "The image is small: letters that look alike can't be told apart.",
}


def policies(spark: SparkSession) -> DataFrame:
    """The three-row dimension of model, size, quality and answer length by class."""
    return spark.createDataFrame(POLICIES, "doc_class string, model string, max_dim int, jpeg_q int, max_tokens int")


def resolution(max_dim, flags):
    """Pixels to send: more for degraded images, up to the most that helps."""
    degraded = F.arrays_overlap(flags, F.array(F.lit("low_sharpness"), F.lit("underexposed"), F.lit("very_low_resolution"), F.lit("truncated_file_recovered")))
    return F.when(degraded, F.least(F.floor(max_dim * BOOST).cast("int"), F.lit(MOST_PIXELS))).otherwise(F.least(max_dim, F.lit(MOST_PIXELS)))


def row_note(field: str) -> str:
    """How rows of a field are to be written: by position."""
    columns = ROW_COLUMNS[field]
    order = ", ".join(f"{k}={name}" for k, name in enumerate(columns))
    return f"{field}: write each row as an array of {len(columns)} values by position ({order}); null where unreadable; every row, none merged."


def field_prompt(doc_class: str, subtype: str | None = None, compact: bool = True) -> str:
    """One line per field of a class; a known subtype leaves out the fields its device does not show."""
    keep = SUBTYPES.get(subtype or "")
    fields = [f for f in FIELDS[doc_class] if keep is None or f[0] in keep]
    lines = [f"{doc_class}:"] + [f"- {name} ({kind}{', required' if required else ''})" for name, kind, required in fields]
    if compact:
        lines += [row_note(name) for name, _, _ in fields if name in ROW_COLUMNS]
    return "\n".join(lines)


def router_prompt() -> str:
    return "Classify the document. Answer with JSON: class (" + ", ".join(CLASSES) + "), confidence 0 to 1, and for meter_reading subtype (" + ", ".join(SUBTYPES) + ")."


def extraction_prompt(doc_class: str, subtype: str | None = None, flags: list[str] | None = None) -> str:
    notes = [QUALITY_NOTES[f] for f in flags or () if f in QUALITY_NOTES]
    return "\n".join(x for x in (field_prompt(doc_class, subtype), HINTS[doc_class], "Answer with JSON: doc_class, confidence, data, refusal {reason, observed}.", *notes) if x)


def baseline_prompt() -> str:
    return "\n\n".join([*(field_prompt(c, compact=False) for c in FIELDS), "Answer with JSON: doc_class, confidence, data, refusal {reason, observed}."])


def cache_material() -> dict:
    """Every choice that can change an answer, for the cache's fingerprint."""
    return {"router": ROUTER, "policies": POLICIES, "prompts": [router_prompt(), baseline_prompt(), *(extraction_prompt(c, s, list(QUALITY_NOTES)) for c in FIELDS for s in (None, *SUBTYPES))], "sizes": [MOST_PIXELS, BOOST]}
