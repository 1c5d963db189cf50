import base64
import json
import logging
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import quillspark.__main__ as cli
from quillspark.functions.cost import priced, prices
from quillspark.logs import JsonFormatter
from quillspark.operators import leaders, rollups, rules, scoring
from quillspark.plans import classes, runs
from quillspark.plans.preflight import preflight
from quillspark.sources import cache, files, ledger, pixels


def greedy(rows, t):
    """The rule itself, one row at a time."""
    kept, out = [], []
    for seq, digest, h in rows:
        exact = next((s for s, d, _ in kept if d == digest), None)
        near = next((s for s, _, g in kept if bin((g ^ h) & (2**64 - 1)).count("1") <= t), None)
        if exact is not None:
            out.append((seq, "duplicate:exact", exact))
        elif near is not None:
            out.append((seq, "duplicate:near", near))
        else:
            kept.append((seq, digest, h))
            out.append((seq, None, None))
    return out


def test_greedy_leaders(spark):
    rnd = random.Random(3)
    rows, seeds = [], [rnd.getrandbits(64) - 2**63 for _ in range(6)]
    for k in range(80):
        h = rnd.choice(seeds)
        for _ in range(rnd.choice([0, 0, 2, 4, 6])):
            h ^= 1 << rnd.randrange(63)
        rows.append((k, f"d{h}" if rnd.random() < 0.8 else f"e{k}", h))
    df = spark.createDataFrame(rows, "seq long, sha256 string, h long")
    assert sorted(map(tuple, leaders.greedy_leaders(df, 5).collect())) == greedy(rows, 5)


@pytest.mark.parametrize(("t", "bits"), [(0, 64), (3, 20), (5, 60), (14, 64)])
def test_near_pairs(spark, t, bits):
    rnd = random.Random(t)
    some = {rnd.getrandbits(bits) for _ in range(40)}
    for h in list(some):
        for _ in range(3):
            some.add(h ^ sum(1 << b for b in rnd.sample(range(bits), rnd.choice([t, t + 1, max(0, t - 1)]))))
    signed = sorted(h - (1 << 64) if h >> 63 else h for h in some)
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= t}
    got = [tuple(r) for r in leaders.near_pairs(spark.createDataFrame([(h,) for h in signed], "h long"), t, bits).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_chain_keeps_its_end(spark):
    rows = [(0, "a", 0), (1, "b", 0b11111), (2, "c", 0b1111111111), (3, "b", 0b11111)]
    got = leaders.greedy_leaders(spark.createDataFrame(rows, "seq long, sha256 string, h long"), 5).collect()
    assert sorted(map(tuple, got)) == [(0, None, None), (1, "duplicate:near", 0), (2, None, None), (3, "duplicate:near", 0)]


def test_screening(spark):
    heads = {b"\xff\xd8\xff..": "image/jpeg", b"\x89PNG\r\n\x1a\n..": "image/png", b"GIF89a": "image/gif", b"BM..": "image/bmp", b"....ftypheic": "image/heic", b"....ftypmp42": None, b"RIFF....WEBP": "image/webp", b"<!DOCTYPE html>": None, b"": None}
    df = spark.createDataFrame([(k, bytearray(h)) for k, h in enumerate(heads)], "k int, content binary")
    rows = files.screened(df).orderBy("k").collect()
    assert [r.mime for r in rows] == list(heads.values())
    assert rows[4].reject_reason == "unsupported_format:heic_needs_transcode"
    assert rows[7].reject_reason == "not_an_image:html_error_page"
    assert rows[8].reject_reason == "not_an_image:unrecognised_format"


def test_scan_and_pixels(spark, tmp_path):
    image = np.tile(np.arange(0, 90, 10, dtype=np.uint8), (8, 1))
    (tmp_path / "a.PNG").write_bytes(b"P5 9 8 255\n" + image.tobytes())
    (tmp_path / "b.jpg").write_bytes(b"broken")
    (tmp_path / "c.txt").write_bytes(b"no")
    found = files.scan(spark, str(tmp_path))
    assert sorted(r.doc_id for r in found.collect()) == ["a", "b"]
    assert [r.doc_id for r in files.scan(spark, str(tmp_path), limit=1).collect()] == ["a"]
    rows = {r.doc_id: r for r in pixels.measured(found).collect()}
    assert rows["a"].dhash == -1 and rows["a"].width == 9 and rows["a"].brightness == 40.0
    assert rows["b"].error.startswith("undecodable:")


def test_ledger(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    assert ledger.read_ledger(spark, path).count() == 0
    calls = spark.createDataFrame(
        [("r", "-", "preflight", "-", 0, 0, 0, 0, 0.0, 0.0, "", 0.0, "x"), ("r", "a", "route", "m", 10, 1, 0, 0, 0.25, 1.23456, "384", 1.26, ""), ("r", "a", "extract", "m", 20, 2, 0, 5, 0.5, 2.0, "1568", 2.0, "")], ledger.LEDGER
    )
    ledger.append_ledger(calls, path)
    back = ledger.read_ledger(spark, path)
    assert sorted(r.latency_s for r in back.collect()) == [0.0, 1.235, 2.0]
    total = rollups.summary(back, n_docs=1).first()
    assert (total.calls, total.input_tokens, float(total.cost_usd), total.cost_per_doc, total.cost_per_1000) == (2, 30, 0.75, 0.75, 750.0)
    assert rollups.summary(back.limit(0)).first().cost_per_doc == 0.0
    rows = {(r.scope, r["name"]): r.calls for r in rollups.rollup(back).collect()}
    assert rows == {("stage", "preflight"): 1, ("stage", "route"): 1, ("stage", "extract"): 1, ("model", "m"): 2, ("total", None): 3}
    per = rollups.cost_per_doc(back.withColumn("seq", F.when(F.col("stage") == "route", 1).otherwise(2))).first()
    assert (per.doc_id, per.cost_usd, [c.stage for c in per.calls]) == ("a", 0.75, ["route", "extract"])


def results(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, doc_class string, status string, raw string")
    return df.withColumn("data", F.parse_json("raw")).drop("raw")


def test_verdicts(spark):
    gold = spark.createDataFrame([(f"d{k}", "vendor_bill", "refuse" if k < 3 else "extract", "x" if k == 0 else None) for k in range(7)], "doc_id string, class string, expect string, duplicate_of string")
    rows = [("d0", "duplicate", "refused", None), ("d1", "vendor_bill", "extracted", '{"a": 1}'), ("d2", "vendor_bill", "extracted", "{}"), ("d3", "vendor_bill", "refused", None), ("d4", "vendor_bill", "extracted", "{}"), ("d5", "work_report", "extracted", "{}")]
    got = {r.doc_id: r.verdict for r in scoring.verdicts(gold, results(spark, rows)).collect()}
    assert got == {"d0": "correctly_refused", "d1": "HALLUCINATED", "d2": "not_refused_but_empty", "d3": "DROPPED_REAL_DOCUMENT", "d4": "routed_ok", "d5": "MISROUTED", "d6": "no_result"}
    s = scoring.score(gold, results(spark, rows)).first()
    assert (s.routing_correct, s.routing_total, s.refusal_correct, s.refusal_total) == (1, 3, 1, 3)
    assert (s.routing_accuracy, s.refusal_accuracy) == (0.3333, 0.3333)


def test_field_scores(spark):
    gold = spark.createDataFrame([("m", "meter_reading", "extract"), ("b", "vendor_bill", "extract"), ("w", "work_report", "extract"), ("z", "vendor_bill", "extract")], "doc_id string, class string, expect string")
    wants = {
        ("meter_reading", "m"): {"reading_type": "odometer", "odometer_km": 1000, "trip_km": 5},
        ("vendor_bill", "b"): {"vendor_name": "Acme Stores", "line_item_count": 2, "vehicle_no": "XX-01", "total_amount": 100, "invoice_date": "2024-01-02", "line_items": []},
        ("work_report", "w"): {"depot": "North Depot", "report_date": "2024-01-02", "entry_count": 3, "bus_codes": ["AB1", "ab-1", "CD2"]},
        ("vendor_bill", "z"): {"vendor_name": "x", "line_items": []},
    }
    fields = spark.createDataFrame([(c, d, f, json.dumps(v)) for (c, d), m in wants.items() for f, v in m.items()], "doc_class string, doc_id string, field string, want string")
    rows = [
        ("m", "meter_reading", "extracted", json.dumps({"reading_type": "Odometer", "odometer_km": "1,003", "trip_km": 9})),
        ("b", "vendor_bill", "extracted", json.dumps({"vendor_name": "acme stores ltd", "line_items": [1, 2], "vehicle_no": "xx01", "total_amount": 101, "invoice_date": "2024-01-02"})),
        ("w", "work_report", "extracted", json.dumps({"depot": "north depot", "report_date": "x", "entries": [{"bus_no": "AB 1"}, {"bus_no": None}]})),
        ("z", "work_report", "extracted", "{}"),
    ]
    judged = scoring.verdicts(gold, results(spark, rows))
    got = {r.doc_id: (r.correct, r.total) for r in scoring.field_scores(judged, fields).collect()}
    assert got == {"m": (2, 3), "b": (4, 5), "w": (3, 5), "z": (0, 2)}


def test_runs(spark):
    rows = [("a", "s1", None, None), ("b", "s2", None, None), ("c", "s3", "not_an_image:html_error_page", None), ("d", "s1", "duplicate:exact", "a"), ("e", "s5", None, None), ("f", "s6", None, None)]
    inbox = spark.createDataFrame(rows, "doc_id string, sha256 string, reject_reason string, duplicate_of string").withColumn("quality_flags", F.array().cast("array<string>"))
    bill = {"vendor_name": "Some Shop", "total_amount": 100, "line_items": [["Part", None, 1, 100, 100]], "invoice_date": "2024-03-01"}
    said = [
        ("a", "route", '{"class": "vendor_bill", "confidence": 2}'),
        ("a", "extract", '```json\n{"confidence": 0.9, "data": ' + json.dumps(bill) + "}\n```"),
        ("b", "route", '{"class": "not_a_document", "confidence": 0.97}'),
        ("e", "route", "garbled"),
        ("e", "extract", '{"refusal": {"reason": "blank", "observed": "wall"}, "data": null, "confidence": 0}'),
        ("f", "route", '{"class": "other"}'),
        ("f", "extract", "[1]"),
        ("a", "baseline", '{"doc_class": "vendor_bill", "confidence": 0.7, "data": {"total_amount": 5}}'),
    ]
    responses = spark.createDataFrame(said, "doc_id string, stage string, text string")
    got = {r.doc_id: r for r in runs.run_optimized(inbox, responses, "2024-03-10").collect()}
    assert {k: (r.doc_class, r.status, r.confidence) for k, r in got.items()} == {
        "a": ("vendor_bill", "extracted", 0.9),
        "b": ("not_a_document", "refused", 0.97),
        "c": ("not_a_document", "refused", 1.0),
        "d": ("duplicate", "refused", 1.0),
        "e": ("work_report", "refused", 0.8),
        "f": ("work_report", "error", 0.0),
    }
    assert json.loads(got["a"].data.toJson())["line_items"] == [{"description": "Part", "hsn": None, "qty": 1, "rate": 100, "amount": 100}]
    base = {r.doc_id: (r.status, r.confidence) for r in runs.run_baseline(inbox.filter("doc_id in ('a', 'b')"), responses, "2024-03-10").collect()}
    assert base == {"a": ("extracted", 0.7), "b": ("error", 0.0)}
    routes = {r.doc_id: (r.doc_class, r.confidence, r.note) for r in runs.routed(responses.filter("stage = 'route'")).collect()}
    assert routes["a"] == ("vendor_bill", 1.0, "") and routes["e"] == ("work_report", 0.0, "router_unparsed:no_json_object; defaulted")
    assert routes["f"][2] == 'router_returned_unknown_class:"other"'


def test_reread_merges_requested_fields_only(spark):
    env = spark.createDataFrame([("a", "meter_reading", "extracted", '{"reading_type": "odometer", "odometer_km": 512345, "trip_km": 10.2}')], "doc_id string, doc_class string, status string, raw string")
    from quillspark.operators.rules import validated

    env = validated(env.withColumn("data", F.parse_json("raw")).drop("raw").withColumn("confidence", F.lit(0.6)), "2024-03-10")
    patch = spark.createDataFrame([("a", '{"odometer_km": 51234.5, "vehicle_no": "zz", "trip_km": null}', ["odometer_km", "trip_km"])], "doc_id string, raw string, fields array<string>").withColumn("patch", F.parse_json("raw")).drop("raw")
    row = runs.reread(env, patch, "2024-03-10").first()
    assert json.loads(row.data.toJson()) == {"reading_type": "odometer", "odometer_km": 51234.5, "trip_km": 10.2}
    assert row.validation.passed and row.confidence == pytest.approx(0.9)


def test_cache(spark, tmp_path):
    path, key = f"file://{tmp_path}/cache", cache.fingerprint(classes.cache_material())
    rows = [("a", "s1", "extracted", 0.9, True), ("b", "s2", "extracted", 0.5, True), ("c", "s3", "refused", 0.95, True), ("d", "s4", "refused", 0.9, True), ("e", "s5", "extracted", 0.9, False)]
    env = spark.createDataFrame(rows, "doc_id string, sha256 string, status string, confidence double, ok boolean").withColumn("validation", F.struct(F.col("ok").alias("passed"))).drop("ok")
    cache.put(env, path, key)
    cache.put(env, path, "other")
    known = cache.entries(spark, path, key)
    inbox = spark.createDataFrame([("x", "s1"), ("y", "s2"), ("z", "s3")], "doc_id string, sha256 string")
    hits, live = cache.lookup(inbox, known)
    assert sorted((r.doc_id, r.status) for r in hits.collect()) == [("x", "extracted"), ("z", "refused")]
    assert [r.doc_id for r in live.collect()] == ["y"]


def test_batch_requests(spark):
    inbox = spark.createDataFrame([("a", bytearray(b"x")), ("b", bytearray(b"y")), ("c", bytearray(b"z"))], "doc_id string, content binary")
    routes = spark.createDataFrame([("a", "meter_reading", "odometer"), ("b", "not_a_document", None)], "doc_id string, doc_class string, subtype string")
    [line] = runs.batch_requests(inbox, "extract", routes).collect()
    request = json.loads(line.value)
    assert request["custom_id"] == "a" and request["body"]["max_tokens"] == 400
    assert "litres" not in request["body"]["messages"][0]["content"][0]["text"]
    assert runs.batch_requests(inbox, "route").count() == 3
    reply = json.dumps({"custom_id": "a", "response": {"body": {"choices": [{"message": {"content": "{}"}}], "usage": {"prompt_tokens": 10, "completion_tokens": 2, "prompt_tokens_details": {"cached_tokens": 4}}}}})
    row = runs.batch_results(spark.createDataFrame([(reply,)], "value string"), "extract").first()
    assert (row.text, row.input_tokens, row.cache_read_tokens) == ("{}", 6, 4)


def bmp_file(grey):
    return pixels.to_bmp(grey)[1]


def test_resampling():
    flat = np.full((700, 900), 77, dtype=np.uint8)
    assert (pixels.resized(flat, 8, 9) == 77).all() and pixels.thumbnail(flat, 640).shape == (498, 640)
    assert pixels.brightness(flat) == 77.0 and pixels.sharpness(flat) > 0  # edges keep their pixels, the rest is flat
    w = pixels._weights(100, 9)
    assert np.allclose(w.sum(axis=1), 1) and w.shape == (9, 100)
    small = np.arange(20, dtype=np.uint8).reshape(4, 5)
    assert (pixels.thumbnail(small, 5) == small).all() and (pixels.resized(small, 4, 5) == small).all()
    ramp = np.tile(np.linspace(0, 255, 1800).astype(np.uint8), (1200, 1))
    assert pixels.difference_hash(ramp) == -1 and pixels.difference_hash(ramp[:, ::-1]) == 0
    assert abs(pixels.brightness(ramp) - ramp.mean()) < 1


def test_preflight(spark):
    rnd = np.random.default_rng(1)
    big = rnd.integers(0, 256, (400, 600), dtype=np.uint8)
    near = big.copy()
    near[0, 0] ^= 1
    dark = (rnd.integers(0, 60, (500, 500))).astype(np.uint8)
    small = np.tile(np.linspace(200, 10, 30).astype(np.uint8), (20, 1))
    contents = {"a.bmp": bmp_file(big), "b.jpg": b"<html>404</html>", "c.bmp": bmp_file(big), "d.bmp": bmp_file(near), "e.bmp": bmp_file(dark), "f.bmp": b"BM broken", "g.bmp": bmp_file(small), "h.heic": b"....ftypheic", "i.bmp": bmp_file(dark[::-1, ::-1])[:-30000], "j.jpg": b""}
    df = spark.createDataFrame([(f"/in/{n}", n.split(".")[0], bytearray(c)) for n, c in contents.items()], "path string, doc_id string, content binary").repartition(4)
    rows = {r.doc_id: r for r in preflight(df).collect()}
    assert {d: r.reject_reason for d, r in rows.items()} == {
        "a": None, "b": "not_an_image:html_error_page", "c": "duplicate:exact", "d": "duplicate:near", "e": None, "f": "undecodable:ValueError",
        "g": None, "h": "unsupported_format:heic_needs_transcode", "i": None, "j": "not_an_image:unrecognised_format",
    }
    assert rows["c"].duplicate_of == rows["d"].duplicate_of == "a" and rows["a"].duplicate_of is None
    assert rows["e"].quality_flags == ["underexposed"] and "very_low_resolution" in rows["g"].quality_flags and rows["i"].quality_flags[0] == "truncated_file_recovered"
    assert rows["d"].quality_flags == [] and rows["a"].ok and not rows["f"].ok
    alone = {r.doc_id: r.reject_reason for r in preflight(df, dedupe=False).collect()}
    assert alone["c"] is None and alone["d"] is None and alone["b"] == rows["b"].reject_reason


def test_provenance(spark):
    calls = spark.createDataFrame([("a", 2, "extract", "m", 10, 5, 0, 0.25), ("a", 1, "route", "m", 3, 1, 0, 0.125), ("-", 3, "screen", "-", 0, 0, 0, 0.0)], "doc_id string, seq long, stage string, model string, input_tokens long, output_tokens long, cache_read_tokens long, cost_usd double")
    out = runs.with_provenance(spark.createDataFrame([("a",), ("b",), ("c",)], "doc_id string"), calls, spark.createDataFrame([("b",)], "doc_id string"))
    got = {r.doc_id: (r.provenance.stages, r.provenance.cost_usd, [c.usd for c in r.provenance.calls]) for r in out.collect()}
    assert got == {"a": (["route", "extract"], 0.375, [0.125, 0.25]), "b": (["cache"], 0.0, [0.0]), "c": ([], 0.0, [])}


def test_results_are_in_order(spark, tmp_path):
    ids = [f"d{k:03}" for k in range(300)]
    ledger.write_results(spark.createDataFrame([(i,) for i in reversed(ids)], "doc_id string").repartition(7), f"{tmp_path}/out")
    lines = [json.loads(x)["doc_id"] for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ids
    ledger.write_report(spark.createDataFrame([(1,)], "n int"), f"{tmp_path}/report")
    assert spark.read.json(f"{tmp_path}/report").first().n == 1


def test_gold_files(spark, tmp_path):
    (tmp_path / "routing.json").write_text(json.dumps({"_about": "x", "labels": {"a": {"class": "vendor_bill", "expect": "extract"}, "b": {"class": "work_report", "expect": "refuse", "duplicate_of": "a"}}}))
    got = {r.doc_id: (r["class"], r.expect, r.duplicate_of) for r in ledger.read_routing_gold(spark, f"{tmp_path}/routing.json").collect()}
    assert got == {"a": ("vendor_bill", "extract", None), "b": ("work_report", "refuse", "a")}
    (tmp_path / "fields.json").write_text(json.dumps({"_note": "x", "vendor_bill": {"a": {"_why": "y", "total_amount": 12.5, "vendor_name": "Q"}}}))
    rows = {(r.doc_class, r.doc_id, r.field): r.want for r in ledger.read_field_gold(spark, f"{tmp_path}/fields.json").collect()}
    assert set(rows) == {("vendor_bill", "a", "total_amount"), ("vendor_bill", "a", "vendor_name")} and float(rows["vendor_bill", "a", "total_amount"]) == 12.5


def test_the_last_result_counts(spark):
    gold = spark.createDataFrame([("a", "vendor_bill", "extract")], "doc_id string, class string, expect string")
    results = spark.createDataFrame([("a", "work_report", "extracted", 1), ("a", "vendor_bill", "extracted", 2)], "doc_id string, doc_class string, status string, seq int").withColumn("data", F.lit(None).cast("variant"))
    assert scoring.score(gold, results, order_col="seq").first().routing_correct == 1


def test_published_totals(spark):
    schema = "doc_id string, stage string, model string, input_tokens long, output_tokens long, cache_write_tokens long, cache_read_tokens long, latency_s double"
    runs_ = [
        [("a", "baseline", "gpt-4o", 111_774, 20_255, 0, 2_048, 254.51)],
        [("a", "route", "gpt-4o-mini", 386_276, 765, 0, 0, 0.0), ("a", "extract", "gpt-4o", 70_455, 16_063, 0, 1_536, 296.85)],
    ]
    sums = [rollups.summary(priced(spark.createDataFrame(rows, schema), prices(spark)), 47) for rows in runs_]
    totals = [s.first() for s in sums]
    assert [round(float(t.cost_usd), 6) for t in totals] == [0.484545, 0.397088]
    assert [t.cost_per_doc for t in totals] == [0.010309, 0.008449]
    both = rollups.comparison(*sums).first()
    assert (both.times_cheaper, both.percent_saved) == (1.22, 18.04)


def test_report_and_evidence(spark):
    schema = "doc_id string, stage string, model string, input_tokens long, output_tokens long, cache_write_tokens long, cache_read_tokens long, latency_s double"
    calls = priced(spark.createDataFrame([("a", "route", "gpt-4o-mini", 1000, 10, 0, 0, 0.1), ("a", "extract", "gpt-4o", 1000, 10, 0, 0, 0.1), ("-", "screen", "-", 0, 0, 0, 0, 0.0)], schema), prices(spark))
    assert [(r.scope, r.name) for r in rollups.report(calls).collect()] == [("stage", "extract"), ("stage", "route"), ("stage", "screen"), ("model", "gpt-4o"), ("model", "gpt-4o-mini"), ("total", None)]
    row = rollups.evidence(calls, spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "doc_id string")).first()
    assert (row.docs, row.calls, row.calls_per_doc) == (4, 2, 0.5)


def test_second_look_requests(spark):
    data = {"a": '{"odometer_km": 250000, "trip_km": 12.5}', "b": '{"odometer_km": 5, "trip_km": 1}'}
    rows = spark.createDataFrame([(d, "meter_reading", "extracted", v) for d, v in data.items()], "doc_id string, doc_class string, status string, v string").withColumn("data", F.parse_json("v"))
    files_ = spark.createDataFrame([("a", "/in/2.jpg", 100, 50), ("b", "/in/1.jpg", 10, 10)], "doc_id string, path string, width int, height int")
    checked = rules.validated(rows, "2024-01-15")
    got = runs.reread_requests(checked, files_).collect()
    assert [(r.doc_id, r.stage, len(r.fields), tuple(r.crop)) for r in got] == [("a", "reread", 5, (0, 5, 100, 44))]
    assert [r.doc_id for r in runs.ordered(checked).collect()] == ["a", "b"] and [r.doc_id for r in runs.ordered(checked, files_).collect()] == ["b", "a"]


def test_prompts_say_what_flags_mean():
    text = classes.extraction_prompt("vendor_bill", flags=["underexposed"])
    assert classes.QUALITY_NOTES["underexposed"] in text and classes.HINTS["vendor_bill"] in text and "vendor_name (string|null, required)" in text
    assert classes.QUALITY_NOTES["low_sharpness"] not in text


def test_batch_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.bmp").write_bytes(bmp_file(np.full((30, 40), 200, dtype=np.uint8)))
    (tmp_path / "in/b.jpg").write_bytes(b"<html>")
    (tmp_path / "in/c.heic").write_bytes(b"....ftypheic")
    assert cli.main(["build", f"{tmp_path}/in", "route", f"{tmp_path}/lines"], spark=spark) == 0
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/lines").collect()]
    assert [x["custom_id"] for x in lines] == ["a"]

    class Jobs:
        def submit(self, lines, state):
            (tmp_path / "state").write_text(lines.decode())
            return {"id": "job-1"}

        def collect(self, state, to):
            return (tmp_path / "state").read_text()

    (tmp_path / "lines.jsonl").write_text("in_progress")
    assert cli.main(["submit", f"{tmp_path}/lines.jsonl", f"{tmp_path}/state"], Jobs()) == 0
    assert cli.main(["collect", f"{tmp_path}/state", f"{tmp_path}/out"], Jobs()) == 3
    (tmp_path / "state").write_text("completed")
    assert cli.main(["collect", f"{tmp_path}/state", f"{tmp_path}/out"], Jobs()) == 0
    assert capsys.readouterr().out.split() == ["job-1", "in_progress", "completed"]


def test_json_logs():
    record = logging.LogRecord("q", logging.WARNING, "f", 1, "%s files", (3,), None)
    row = json.loads(JsonFormatter().format(record))
    assert (row["level"], row["logger"], row["message"]) == ("WARNING", "q", "3 files") and row["ts"].endswith("Z")


def test_encoding(spark):
    grey = np.random.default_rng(3).integers(0, 256, (40, 100), dtype=np.uint8)
    assert (pixels.bmp(bmp_file(grey))[0] == grey).all() and pixels.bmp(bmp_file(grey))[1] is False
    df = spark.createDataFrame([("a", bytearray(bmp_file(grey)), 50), ("b", bytearray(b"BM"), 50), ("c", bytearray(bmp_file(grey)), 200)], "doc_id string, content binary, max_dim int")
    got = {r.doc_id: r for r in pixels.encoded(df).collect()}
    assert {d: r.image_px for d, r in got.items()} == {"a": "50x20", "c": "100x40"}
    assert (pixels.bmp(base64.b64decode(got["c"].body))[0] == grey).all() and got["a"].media_type == "image/bmp"


def test_ledger_of_a_run(spark, tmp_path):
    responses = spark.createDataFrame([("a", "route", "x", 1_000_000, 0, 0, 0, 0.12345), ("a", "extract", "x", 1_000_000, 0, 0, 0, 1.0)], runs.RESPONSES)
    rows = runs.ledger_rows(responses, "r1", prices(spark)).unionByName(runs.screening_row(spark.createDataFrame([(True,), (False,)], "ok boolean"), "r1"), allowMissingColumns=True)
    ledger.append_ledger(rows.withColumns({"image_kb": F.lit(1.26), "image_px": F.lit("1x1")}), f"{tmp_path}/ledger")
    got = {r.stage: (r.model, round(r.cost_usd, 6), r.latency_s, r.note) for r in ledger.read_ledger(spark, f"{tmp_path}/ledger").collect()}
    assert got == {"route": ("gpt-4o-mini", 0.15, 0.123, None), "extract": ("gpt-4o", 2.5, 1.0, None), "preflight": ("-", 0.0, 0.0, "screened=2 passed=1")}
