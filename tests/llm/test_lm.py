import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import gru, lm, queries

DOCS = "doc_id long, text string, score double"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [w.decode() for w in (text or "").translate(LOWER).encode().split()] + [None]  # the end


def is_held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def counts_by_hand(rows):
    counts = Counter(t for d, text in rows if not is_held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        ts = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        out.append((d, is_held(d), len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 6)))
    return sorted(out, key=str)


def model(seed=1, n=40, classes=5, hidden=6):
    rng = np.random.default_rng(seed)
    m = gru.Model.new(np.r_[50, 10, np.sort(rng.integers(1, 100, n))[::-1]], classes, hidden)
    for k, x in m.arrays.items():
        m.arrays[k] = (x + rng.normal(0, 0.3, x.shape)).astype(np.float32)
    return m


def next_logs(m, h):
    """Log probabilities of all symbols after state h, in doubles."""
    a = {k: v.astype(float) for k, v in m.arrays.items()}
    c = h @ a["classes"] + a["class_bias"]
    c -= np.logaddexp.reduce(c)
    out = np.empty(len(a["words"]))
    for k, (i, j) in enumerate(zip(m.starts[:-1], m.starts[1:])):
        w = a["words"][i:j] @ h + a["word_bias"][i:j]
        out[i:j] = c[k] + w - np.logaddexp.reduce(w)
    return out


def step(m, h, symbol):
    a = {k: v.astype(float) for k, v in m.arrays.items()}
    d = len(h)
    x, g = a["inputs"][symbol], h @ a["state"]
    z, r = (1 / (1 + np.exp(-(x[k * d : (k + 1) * d] + g[k * d : (k + 1) * d]))) for k in (0, 1))
    new = np.tanh(x[2 * d :] + r * g[2 * d :])
    return new + z * (h - new)


def score_by_hand(m, text):
    h, total, given = np.zeros(m.arrays["state"].shape[0]), 0.0, len(m.arrays["inputs"]) - 1
    for t in text:
        h = step(m, h, given)
        total, given = total + next_logs(m, h)[t], t
    return total


def some_texts(seed, n_symbols, sizes):
    rng = np.random.default_rng(seed)
    return [np.r_[rng.integers(0, n_symbols, k), gru.END].astype(np.int32) for k in sizes]


def test_scores_are_log_probabilities(monkeypatch):
    monkeypatch.setattr(gru, "WINDOW", 4)
    m = model()
    assert m.starts[0] == 0 and m.starts[-1] == 42 and (np.diff(m.starts) > 0).all()
    h = np.random.default_rng(2).normal(0, 0.5, 6)
    assert abs(np.exp(next_logs(m, h)).sum() - 1) < 1e-9
    texts = some_texts(3, 42, [0, 1, 3, 4, 5, 30, 2, 17])
    got = gru.scores(m, texts)
    assert np.allclose(got, [score_by_hand(m, t) for t in texts], atol=1e-3)
    monkeypatch.setattr(gru, "LANES", 2)
    monkeypatch.setattr(gru, "SAFE", 0.0)
    assert np.allclose(gru.scores(m, texts), got, atol=1e-3) and len(gru.scores(m, [])) == 0


def test_gradients(monkeypatch):
    """Updates of one window against differences of the score."""
    monkeypatch.setattr(gru, "LANES", 3)
    m, texts = model(4), some_texts(5, 42, [5, 2, 9, 3])
    scale = 1 / (3 * gru.WINDOW)
    seen = {}
    monkeypatch.setattr(gru, "_update", lambda _, grads, rate: seen.update({k: g.copy() for k, g in grads.items()}))
    monkeypatch.setattr(gru, "_update_rows", lambda _, rows, grads, rate: seen.update(inputs=(rows.copy(), grads.copy())))
    assert gru.learn(m, texts) == sum(map(len, texts))
    rows, by_row = seen.pop("inputs")
    seen["inputs"] = np.zeros_like(m.arrays["inputs"])
    np.add.at(seen["inputs"], rows, by_row)
    rng = random.Random(6)
    for name, grads in seen.items():
        for _ in range(6):
            at = tuple(rng.randrange(k) for k in grads.shape)
            sums = []
            for e in (1e-3, -1e-3):
                m.arrays[name] = m.arrays[name].astype(np.float64)
                m.arrays[name][at] += e
                sums.append(sum(score_by_hand(m, t) for t in texts))
                m.arrays[name][at] -= e
            assert abs(-(sums[0] - sums[1]) / 2e-3 * scale - grads[at]) < 1e-5, name


def test_learning_finds_order():
    rng = np.random.default_rng(7)
    texts = []
    for _ in range(400):
        k = int(rng.integers(0, 10))
        texts.append(np.array([2 + (k + i) % 10 for i in range(30)] + [gru.END], dtype=np.int32))
    counts = np.bincount(np.concatenate(texts), minlength=12)
    m = gru.Model.new(counts, 3)
    before = gru.scores(m, texts).sum()
    for _ in range(12):
        gru.learn(m, texts)
    assert gru.scores(m, texts).sum() > before / 2
    assert np.allclose(gru.scores(m.filled(m.flat()), texts), gru.scores(m, texts))


def test_counts_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "MODELLED", 12)
    monkeypatch.setattr(lm, "HELD_WORDS", 9)
    rnd = random.Random(8)
    words = ["the", "Of", "É", "x" * 3000, "a\xa0b", *(f"w{k}" for k in range(30))]
    rows = [(k, rnd.choice([" ", "\n", "\t "]).join(rnd.choices(words, k=rnd.randint(0, 40)))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, "\r\n "), (None, "the of"), (None, None), (3, "the the"), (3, "the the"), (70, "long " * 9000), (71, "Only here")]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], DOCS).repartition(3)
    out = lm.lm_scores(df)
    assert out.columns == COLUMNS
    got = [tuple(r) for r in out.collect()]
    assert sorted(((*r[:5], round(r[5], 6)) for r in got), key=str) == counts_by_hand(rows)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)
    assert lm.lm_scores(df.limit(0)).collect() == []
    held = [k for k in range(200) if is_held(k)][:3]
    only = [tuple(r) for r in lm.lm_scores(spark.createDataFrame([(k, "a b", 0.0) for k in held], DOCS)).collect()]
    assert [r[1:6] for r in only] == [(True, 3, 0, 0, 0.0)] * 3


def test_query_beats_counts_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op11_lm_scores(spark, sf).collect()]
    want = {r[0]: r for r in counts_by_hand(rows)}
    assert len(got) == len(want) and all(r[:5] == want[r[0]][:5] and math.isclose(r[5], want[r[0]][5], rel_tol=1e-7) for r in got)
    base, score, n = (sum(r[k] for r in got if r[1]) for k in (5, 6, 2))
    print("held out, log10 a token:", base / n, score / n)
    assert score > base + 0.05 * n


def test_outputs_are_a_softmax_over_classes_and_words():
    rng = np.random.default_rng(3)
    model = gru.Model.new(rng.integers(1, 500, 40), 5)
    a, starts, of = model.arrays, model.starts, model.class_of()
    a["words"][...], a["classes"][...] = rng.normal(0, 1, a["words"].shape), rng.normal(0, 1, a["classes"].shape)
    h, wanted = rng.uniform(-1, 1, (200, 16)).astype(np.float32), rng.integers(0, 40, 200)
    log_softmax = lambda x: x - np.logaddexp.reduce(x)
    want = []
    for state, w in zip(h.astype(float), wanted):
        c = of[w]
        i, j = starts[c], starts[c + 1]
        want.append(log_softmax(state @ a["classes"] + a["class_bias"])[c] + log_softmax(a["words"][i:j] @ state + a["word_bias"][i:j])[w - i])
    got, back = gru._outputs(a, starts, of, h, wanted)
    assert back is None and np.allclose(got, want, atol=1e-4)


def test_frequent_words_find_their_counts_in_the_tasks(spark, monkeypatch):
    """Only words that tasks have no counts of are dealt out; results do not depend on which these are."""
    monkeypatch.setattr(lm, "MODELLED", 5)
    rnd = random.Random(9)
    rows = [(k, " ".join(f"w{int(rnd.paretovariate(0.6)) % 400}" for _ in range(rnd.randint(0, 60)))) for k in range(80)]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], DOCS).repartition(3)
    encode, dealt = lm._encode, []
    monkeypatch.setattr(lm, "_encode", lambda known: dealt.append(known.value) or encode(known))
    scores = []
    for most in (0, 20, 100_000):
        monkeypatch.setattr(lm, "LOOKED_UP", most)
        got = sorted((tuple(r) for r in lm.lm_scores(df).collect()), key=str)
        assert sorted(((*r[:5], round(r[5], 6)) for r in got), key=str) == counts_by_hand(rows)
        scores.append([r[6] for r in sorted(got)])
    assert np.allclose(scores[0], scores[1], rtol=1e-3) and np.allclose(scores[0], scores[2], rtol=1e-3)
    trained = Counter(t for d, text in rows if not is_held(d) for t in tokens(text) if t)
    sizes = [len(number) for number, _, _ in dealt]
    assert sizes[0] == 5 and 5 < sizes[1] <= 20 and sizes[2] == len(trained)
    for number, n_symbols, logs in dealt:
        assert n_symbols == 7 and all(math.isclose(10 ** logs[k] - 1, trained[w.decode()]) for w, k in number.items())
        assert set(map(trained.get, (w.decode() for w in number))) >= {c for _, c in trained.most_common(len(number))}


def test_few_lanes_go_in_long_windows(monkeypatch):
    m, texts = model(), some_texts(10, 42, [5000, 3, 7])
    sizes, outputs = [], gru._outputs
    monkeypatch.setattr(gru, "_outputs", lambda a, starts, of, h, *rest: sizes.append(len(h)) or outputs(a, starts, of, h, *rest))
    got = gru.scores(m, texts)
    assert sum(sizes) == sum(map(len, texts)) and len(sizes) <= 2
    assert np.allclose(got, [score_by_hand(m, t) for t in texts], rtol=1e-4)


def test_shares_by_blocks_of_rows(monkeypatch):
    """Gradients of outputs, by differences, whatever the blocks; logits far below their bound too."""
    m = model(11)
    rng = np.random.default_rng(12)
    h, wanted = rng.uniform(-1, 1, (50, 6)).astype(np.float32), rng.integers(0, 42, 50)
    found = []
    for rows, safe in ((7, 60.0), (2048, 60.0), (7, 0.0)):
        monkeypatch.setattr(gru, "ROWS", rows)
        monkeypatch.setattr(gru, "SAFE", safe)
        grads = {k: np.zeros_like(v) for k, v in m.arrays.items()}
        found.append((*gru._outputs(m.arrays, m.starts, m.class_of(), h, wanted, grads, 0.5), *grads.values()))
    for one in found[1:]:
        assert all(np.allclose(x, y, atol=1e-5) for x, y in zip(found[0], one))
    for i in (0, 31):
        for k in range(6):
            sums = []
            for e in (1e-3, -1e-3):
                moved = h[i].astype(float)
                moved[k] += e
                sums.append(next_logs(m, moved)[wanted[i]])
            assert abs(-0.5 * (sums[0] - sums[1]) / 2e-3 - found[0][1][i, k]) < 1e-4


def test_words_of_texts_as_bytes_split_them():
    bodies = [b"", b"  ", b"\xff\xfeA b\x1c x\x85", b" lead  The the ", b"\r\n", b"a\x00B\x0bc\xc2\xa0d", b"\xc3\x89T\x09\xc3\xa9"]
    for some in (pa.array(bodies, pa.binary()), pa.array([b"cut off", *bodies], pa.binary()).slice(1)):
        words, ends = lm._words(some)
        got = words.view(pa.binary()).to_pylist()
        assert [got[i:j] for i, j in zip(ends, ends[1:])] == [b.translate(lm.LOWER).split() for b in bodies]
