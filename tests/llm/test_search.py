import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillspark.llm import queries, search

DOCS, ITEMS = "doc_id long, text string, n_chars long", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans(search.UPPER, search.LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, some in wanted.items():
        scored = []
        for (doc, c), n in zip(counts, lengths):
            m = n and 100 - 90 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in some if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_against_all_scores(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(search, "SHARD_BYTES", 3000)
    monkeypatch.setattr(search, "COUNT_AT_ONCE", 100)
    monkeypatch.setattr(search, "QUERY_ROWS", 40)
    words = [w for k in range(60) for w in [f"w{k}"] * (1 + 200 // (k + 1))] + ["Été", "AÉB", "日本", "x'y", "a-b"]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in rnd.sample(range(-50, 1000), 300)]
    docs += [(2000, None), (2001, ""), (2002, "!? --"), (None, "w1 w2"), (None, "w1 w2"), (3, "w1 w2"), (3, "w1 w2"), (2003, "w5 " * 5000), (2004, "Z" * 20_000)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 25)))) for i in range(30)] + [(40, None), (41, "!"), (42, "unheard"), (43, "z" * 20_000), (5, "w7 Été"), (None, "w1"), (None, "W2")]
    got = found(search.ranked(spark.createDataFrame([(*d, 0) for d in docs], DOCS).repartition(5), spark.createDataFrame(items, ITEMS)))
    assert got == by_hand(docs, items)


def test_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(search, "SLICE_BYTES", 64)
    docs = [(1, " ".join(f"t{k % 37}" for k in range(4000))), (2, "t1 t2 " + "long" * 200 + " t3")]
    items = [(1, "t1 t36"), (2, "long" * 200)]
    one, two = spark.createDataFrame([(*d, 0) for d in docs], DOCS), spark.createDataFrame(items, ITEMS)
    assert found(search.ranked(one, two)) == by_hand(docs, items)
    assert found(search.ranked(one.limit(0), two)) == [] and found(search.ranked(one, two.limit(0))) == []


def test_merge_with_bounds():
    rnd = random.Random(5)
    for _ in range(300):
        lists = []
        for _ in range(rnd.randint(1, 8)):
            docs = sorted(rnd.sample(range(60), rnd.randint(1, 60)))
            scores = [rnd.choice([0, 1, 2, 3, 50]) if rnd.random() < 0.9 else 0 for _ in docs]
            lists.append((max(scores), docs, scores))
        total = Counter()
        for _, docs, scores in lists:
            total.update(dict(zip(docs, scores)))
        k = rnd.randint(1, 12)
        want = sorted(((-s, d) for d, s in total.items() if s))[:k]
        assert sorted((-s, d) for s, d in search.best(lists, k)) == want


def test_numbers_are_packed_and_read_again():
    rnd = np.random.default_rng(1)
    values = np.r_[np.array([0, 1, 127, 128, (1 << 64) - 1, 1 << 63], dtype=np.uint64), rnd.integers(0, 1 << 40, 1000).astype(np.uint64)]
    data, size = search.packed(values)
    assert (search.unpacked(data.tobytes()) == values).all() and size[:4].tolist() == [1, 1, 1, 2]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(queries.op12_ranked_search(spark, sf)) == by_hand(docs, items)
