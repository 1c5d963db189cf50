from collections import Counter

import pytest

import corpus_pipeline
from quillspark.llm import common

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        now = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(now) == len(set(now)) and set(now) <= ids
        ids = set(now)
        for r in docs.collect():
            assert r.n_chars == len(r.text) or name != "repeats"
            assert name in ("repeats", "leaks") or r.text == texts[r.doc_id]
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in r.text for r in docs.collect() for b in bench)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


def test_run(spark):
    begun = len(common._OPEN)
    assert corpus_pipeline.run(spark, SF).count() > 0
    # What the stages wrote besides their results has gone.
    assert len(common._OPEN) == begun + 1


ODD = "doc_id long, text string, lang string, source string, n_chars long, num string, kept string, row int"


def odd_rows(spark):
    prose = " ".join(f"word{k}x" for k in range(70))
    shared = " ".join(f"common{k}" for k in range(60))
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [
        (1, prose, "en", "a", len(prose), "n", "k", 1),
        (1, prose, "en", "a", len(prose), "n", "k", 1),
        (2, prose.upper(), None, None, None, None, None, None),
        (None, prose + " and other words at the end", "de", "a", 1, None, "x", 2),
        (3, None, "en", "a", 0, "n", "k", 3),
        (4, "", "en", "a", 0, "n", "k", 4),
        (5, " ".join(f"first{k}" for k in range(80)) + " " + shared, "en", "b", 5, "n", "k", 5),
        (6, shared + " " + " ".join(f"second{k}" for k in range(80)), "xx", "b", 5, "n", "k", 6),
        (7, " ".join(f"third{k}" for k in range(50)) + " " + leak, "en", "b", 5, "n", "k", 7),
        (8, " ".join(f"long{k}" for k in range(60_000)), "en", "b", 5, "n", "k", 8),
    ]
    return spark.createDataFrame(rows, ODD), leak, shared


def test_stages_on_odd_rows(spark):
    df, leak, shared = odd_rows(spark)
    stage = dict(corpus_pipeline.STAGES)
    left = {}
    for name in list(stage)[:-1]:
        out = stage[name](spark, df, SF)
        assert out.columns == df.columns
        left[name] = Counter((r.doc_id, r.num, r.row) for r in out.collect())
    rows = Counter((r.doc_id, r.num, r.row) for r in df.collect())
    gone = {name: sorted((rows - c).elements(), key=str) for name, c in left.items()}
    # Null and empty texts have too few words; the other rules have nothing to go by.
    assert gone["quality"] == [(3, "n", 3), (4, "n", 4)]
    # One of the five rows that share nearly all shingles stays, the least id's; texts without words stay, one an id.
    assert left["near_duplicates"] == Counter({(1, "n", 1): 1, (3, "n", 3): 1, (4, "n", 4): 1, (5, "n", 5): 1, (6, "n", 6): 1, (7, "n", 7): 1, (8, "n", 8): 1})
    assert gone["repeats"] == [] and gone["leaks"] == [(7, "n", 7)]
    texts = {(r.doc_id, r.row): r for r in stage["repeats"](spark, df, SF).collect()}
    assert all(shared[:-1] not in (texts[k].text or "") for k in ((5, 5), (6, 6))) and texts[5, 5].text.startswith("first0 ") and texts[6, 6].text.endswith(" second79")
    assert texts[3, 3].text is None and texts[4, 4].text == "" and all(r.n_chars == len(r.text) for r in texts.values() if r.text is not None)
    packed = stage["packing"](spark, df, SF).collect()
    assert {r.doc_id for r in packed} == {None, 1, 2, 3, 4, 5, 6, 7, 8} and all(r.doc_tokens == 1 for r in packed if r.doc_id in (3, 4))
    assert Counter(r.doc_id for r in packed)[8] > 5


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    df, *_ = odd_rows(spark)
    assert dict(corpus_pipeline.STAGES)[name](spark, df.limit(0), SF).count() == 0
