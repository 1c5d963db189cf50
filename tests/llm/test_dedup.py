import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillspark.llm import cover_dedup, sketch_dedup, suffix_dedup
from quillspark.llm.common import Scratch
from quillspark.llm.components import components as components_of
from quillspark.llm.rolling import BYTE_VALUES, PRIME_BASE, PrimePrefixes, SuffixOrder, single_spaced, word_hashes, words

import numpy as np

DOCS = "doc_id long, text string"


def corpus(seed):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("abcd") + str(rnd.randint(0, 30)) for _ in range(300)) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "x " * 900), (3, "x " * 400), (4, "é" * 450), (5, "a" + "é" * 450)]
    for i in range(6, 60):
        words = rnd.choice(base).split()
        n = rnd.randint(1, 300)
        s = rnd.randint(0, 300 - n)
        part = words[s : s + n]
        for _ in range(rnd.choice([0, 0, 1, 3])):
            part[rnd.randrange(n)] = f"E{rnd.randint(0, 3)}"
        head = [f"p{rnd.randint(0, 999)}" for _ in range(rnd.randint(0, 40))]
        rows.append((i, " ".join(head + part + [f"q{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 5))])))
    return [*rows, rows[10], rows[11], (3, "other"), (None, rows[12][1])]


def marks(sequences, width):
    """By brute force: which symbols lie in a window that also starts elsewhere."""
    seen = Counter(s[p : p + width] for s in sequences for p in range(len(s) - width + 1))
    out = []
    for s in sequences:
        hit = bytearray(len(s))
        for p in range(len(s) - width + 1):
            if seen[s[p : p + width]] > 1:
                hit[p : p + width] = b"\1" * width
        out.append(hit)
    return out


@pytest.fixture(params=[False, True], ids=["sorted", "by_digest"])
def hot(request, monkeypatch):
    """With and without anchors that have more contexts than one task sorts."""
    if request.param:
        for module, name in ((suffix_dedup, "ByteWindows"), (cover_dedup, "WordWindows")):
            kind = getattr(module, name)

            def made(width, kind=kind):
                out = kind(width)
                out.hot = 2
                return out

            monkeypatch.setattr(module, name, made)


@pytest.mark.parametrize("seed", [5, 6])
def test_repeated_bytes(spark, seed, hot):
    rows = corpus(seed)
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (doc, _), body, hit in zip(rows, texts, marks(texts, 400)):
        spans = sum(1 for k in range(len(hit)) if hit[k] and not (k and hit[k - 1]))
        want.append((doc, len(body), sum(hit), spans, hashlib.sha256(bytes(b for b, h in zip(body, hit) if not h)).hexdigest()))
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("n_bytes", F.lit("clash"))
    got = [tuple(r)[:5] for r in suffix_dedup.remove_repeats(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_passages_of_over_50_words_go_by_their_bytes(spark):
    """Of 51 to 60 words most have less than the contract's 400 bytes and stay; a repeat of 400 goes, one of 399 does not."""
    rnd = random.Random(9)
    noise = lambda n: "".join(rnd.choices("ABCDEFGHIJ", k=n))
    passages = {n: " ".join(noise(len(w)) for w in np.array_split(np.zeros(n - 54), 55)) for n in (330, 399, 400, 430)}
    assert all((len(p), len(p.split())) == (n, 55) for n, p in passages.items())
    df = spark.createDataFrame([(n * 10 + k, f"{noise(300)} {k}{p}{'xy'[k]} {noise(200)}") for n, p in passages.items() for k in (0, 1)], DOCS)
    lost = lambda width: {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(df, width=width).collect()}
    assert lost(400) == {n * 10 + k: n * (n >= 400) for n in passages for k in (0, 1)}
    assert lost(250) == {n * 10 + k: n for n in passages for k in (0, 1)}


def test_repeated_words(spark, hot):
    rows = corpus(7)
    texts = [tuple((t or "").encode().split()) for _, t in rows]
    want = [(doc, len(words), sum(hit), hashlib.sha256(b" ".join(w for w, h in zip(words, hit) if not h)).hexdigest()) for (doc, _), words, hit in zip(rows, texts, marks(texts, 35))]
    got = [tuple(r)[:4] for r in cover_dedup.remove_passages(spark.createDataFrame(rows, DOCS).repartition(3).withColumn("n_words", F.lit("clash"))).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_texts_are_parted_without_a_trace():
    body = (" ".join(f"w{k * k % 997}" for k in range(3000))).encode()
    whole, parted = suffix_dedup.ByteWindows(), suffix_dedup.ByteWindows()
    parted.slice = 1000
    windows = lambda w: sorted({(int(a), int(p)) for c in w.anchors([body]) for a, lo, hi in zip(c["a"], c["lo"], c["hi"]) for p in range(a - lo, a - lo + hi + 1)})
    assert windows(whole) == windows(parted)
    words, cut = cover_dedup.WordWindows(), cover_dedup.WordWindows()
    cut.slice = 777
    # Covers count from the start of a slice, so anchors differ; each window has five of them, at other places in it.
    for some in (windows(words), windows(cut)):
        assert Counter(p for _, p in some) == dict.fromkeys(range(3000 - 34), 5)
        assert all(p <= a <= p + 20 for a, p in some)


def thue_morse(k, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(1 << k))


def test_words_that_polynomials_take_for_one(spark):
    same = [f"word{k}" for k in range(40)]
    rows = [(k, " ".join([*same[:20], w, *same[20:]])) for k, w in enumerate((thue_morse(10, "a", "b"), thue_morse(10, "b", "a")))]
    df = spark.createDataFrame(rows, DOCS)
    assert [(r.n_words, r.n_removed) for r in cover_dedup.remove_passages(df).collect()] == [(41, 0)] * 2
    alone = spark.createDataFrame([(k, t.split()[20]) for k, t in rows], DOCS)
    assert sorted(r.component_id for r in sketch_dedup.near_duplicates(alone, 4, 80).collect()) == [0, 1]
    got = [r.n_removed for r in suffix_dedup.remove_repeats(alone).collect()]
    texts = [t.split()[20].encode() for _, t in rows]
    assert got == [sum(h) for h in marks(texts, 400)]


def test_hashes_of_words():
    rnd = random.Random(2)
    some = [bytes(rnd.choice(b"abc") for _ in range(rnd.choice([1, 2, 7, 8, 9, 16, 17, 63, 64, 65, 200]))) for _ in range(3000)]
    data = b"  ".join(some) + b"\n"
    _, hashes = words(data)
    assert len({(w, int(h)) for w, h in zip(some, hashes)}) == len(set(some)) == len(set(hashes.tolist()))
    one, starts, ends = single_spaced(b"\t" + data)
    assert one == b" ".join(some) and [one[i:j] for i, j in zip(starts, ends)] == some
    assert (word_hashes(one, starts, ends) == hashes).all()


def test_prime_prefixes():
    rnd = random.Random(4)
    values = [rnd.randrange(1 << 64) for _ in range(500)]
    values[300:400] = values[100:200]
    own, p = PrimePrefixes(np.array(values, dtype=np.uint64)), (1 << 61) - 1
    whole = lambda a, n: sum(v * pow(PRIME_BASE, k, p) for k, v in enumerate(values[a : a + n])) % p
    a, b, n = (np.array([rnd.randrange(200) for _ in range(400)]) for _ in range(3))
    a[:99], b[:99], n[:99] = np.arange(300, 399), np.arange(100, 199), np.arange(99, 0, -1)
    assert own.same(a, b, n).tolist() == [whole(x, k) == whole(y, k) for x, y, k in zip(a.tolist(), b.tolist(), n.tolist())]
    assert own.same(a, b, n)[:99].all()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert cover_dedup.remove_passages(empty).count() == 0
    assert sketch_dedup.near_duplicates(empty).count() == 0


def test_cut_texts_keep_rows_and_columns(spark):
    rows = [(1, "é" * 300 + "tail", "a"), (2, "x" + "é" * 300, "b"), (3, None, "c"), (4, "short", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, num string")
    got = {r.doc_id: (r.text, r.num) for r in suffix_dedup.without_repeats(df).collect()}
    assert got == {1: ("tail", "a"), 2: ("x", "b"), 3: (None, "c"), 4: ("short", None)}


def test_suffix_order():
    rnd = random.Random(8)
    text = np.array([rnd.randint(0, 2) for _ in range(900)], dtype=np.uint8)
    starts = np.arange(0, 900 - 40)
    groups = np.sort(np.array([rnd.randint(0, 3) for _ in starts]))
    order = SuffixOrder(text, BYTE_VALUES[text], 40)
    placed = starts[order.sort(starts, groups)]
    key = lambda p: bytes(text[p : p + 40])
    for g in range(4):
        mine = placed[groups == g]
        assert [key(p) for p in mine] == sorted(key(p) for p in starts[groups == g])
    equal = order.equal_neighbours(placed, groups)
    assert [bool(e) for e in equal[:-1]] == [groups[k] == groups[k + 1] and key(placed[k]) == key(placed[k + 1]) for k in range(len(placed) - 1)]


def components(rows, n, similarity):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for _, text in rows:
        w = (text or "").encode().translate(lower).split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)], doc == least[find(i)]) for i, (doc, _) in enumerate(rows))


def near_corpus():
    rnd = random.Random(5)
    rows = [(0, None), (1, ""), (2, "  \n"), (3, "a b"), (4, "A  B"), (5, "a b c d"), (6, "a b c d e"), (7, "a b")]
    base = [f"w{rnd.randint(0, 50)}" for _ in range(120)]
    for i in range(10, 110):
        words = base[: rnd.randint(60, 120)]
        for _ in range(rnd.choice([0, 1, 2, 3, 5])):
            words[rnd.randrange(len(words))] = f"E{rnd.randint(0, 30)}"
        rows.append((i, " ".join(words)))
    return rows


def test_near_duplicates(spark):
    rows = near_corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("component", F.lit(1))
    assert sorted(map(tuple, sketch_dedup.near_duplicates(df, 4, 80).collect())) == components(rows, 4, 80)


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, local):
    rnd = random.Random(6)
    path = list(range(40))
    rnd.shuffle(path)
    links = [*zip(path, path[1:]), *[(100, 100 + k) for k in range(1, 30)], (200, 201), (201, 200), (202, 202), (-5, 203), *[(rnd.randint(300, 360), rnd.randint(300, 360)) for _ in range(40)]]
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    scratch = Scratch(spark, "components-test")
    got = {r.node: r.root for r in components_of(spark.createDataFrame(links, "a long, b long").repartition(3), scratch, "t", local=local).collect()}
    assert got == {v: find(v) for v in root if find(v) != v}
    assert components_of(spark.createDataFrame([], "a long, b long"), scratch, "none", local=local).count() == 0


def true_links(sets, least):
    """All pairs of sets of the similarity, by way of the rarest members, of which two such sets share one."""
    seen = Counter(x for s in sets for x in s)
    holders, pairs = {}, set()
    for i, s in enumerate(sets):
        rare = sorted(s, key=lambda x: (seen[x], x))[: len(s) - -(-least * len(s) // 100) + 1]
        near = {j for x in rare for j in holders.get(x, ())}
        pairs |= {(j, i) for j in near if 100 * len(s & sets[j]) >= least * len(s | sets[j])}
        for x in rare:
            holders.setdefault(x, []).append(i)
    return pairs


def links_lost(spark, sf, n, least):
    """(true links, those whose ends are in two components, rows with a component that no true link explains)."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.component_id for r in sketch_dedup.near_duplicates(docs, n, least).collect()}
    rows = [(r.doc_id, sketch_dedup.exact(r.text.encode(), n)) for r in docs.collect()]
    pairs = true_links([s for _, s in rows], least)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in pairs:
        root[find(i)] = find(j)
    first = {}
    for i, (doc, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), doc), doc)
    return len(pairs), sum(got[rows[i][0]] != got[rows[j][0]] for i, j in pairs), sum(got[doc] != first[find(i)] for i, (doc, _) in enumerate(rows))


def test_no_link_is_lost(spark):
    n, lost, wrong = links_lost(spark, "sf0.01", 5, 80)
    assert n > 50 and not lost and not wrong


def test_near_duplicates_with_null_ids_repeats_and_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(120_000))
    rows = [(None, long), (7, long + " end"), (7, long + " end"), (None, "alone in the world it is"), (None, None), (9, "Alone in the world it is"), (8, "")]
    got = sketch_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), 4, 80).collect()
    want = [(None, 119_997, 7, False), (7, 119_998, 7, True), (7, 119_998, 7, True), (None, 3, 9, False), (None, 0, None, True), (9, 3, 9, True), (8, 0, 8, True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_less_than_80_is_refused(spark):
    with pytest.raises(ValueError, match="80"):
        sketch_dedup.near_duplicates(spark.createDataFrame(near_corpus(), DOCS), 4, 79)


def test_one_of_each(spark):
    rows = [(1, "one two three four five six", "a"), (2, "One two three four five six", "b"), (2, "seven eight nine", "c"), (3, None, "d"), (4, "", "e"), (1, "one two three four five six", "a")]
    got = sketch_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, cls string")).collect()
    assert sorted((r.doc_id, r.cls) for r in got) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]


def test_sketches_agree_as_often_as_sets_do():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 1 << 63, size=600, dtype=np.uint64)
    a, b = np.sort(pool[:500]), np.sort(pool[100:])
    s = sketch_dedup.sketches(np.array([500, 1000]), np.r_[a, b])
    assert abs((s[0] == s[1]).mean() - 400 / 600) < 0.12
    one = sketch_dedup.sketches(np.array([1]), pool[:1])
    assert (one != sketch_dedup.EMPTY).all()


#: Two words that a chain of invertible steps over their bytes hashed alike.
TWINS = "baselinemeasured", "g9puo4lx3t*h/'x."


def test_nothing_is_linked_by_hashes_alone(spark):
    first, second = (" ".join(t if k % 2 else f"w{k}" for k in range(120)) for t in TWINS)
    rows = [(0, TWINS[0]), (1, TWINS[1]), (2, first), (3, second), (4, " ".join((*TWINS, TWINS[0], *TWINS, TWINS[1], TWINS[1])))]
    got = sorted(map(tuple, sketch_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), 4, 80).collect()))
    assert got == [(0, 1, 0, True), (1, 1, 1, True), (2, 117, 2, True), (3, 117, 3, True), (4, 4, 4, True)]
    assert got == components(rows, 4, 80)
    kept = sketch_dedup.one_of_each(spark.createDataFrame(rows, DOCS), n_words=4)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_equal_sets_of_different_texts(spark):
    rows = [(k, ("  " if k % 2 else " ").join(f"{'W' if k % 3 else 'w'}{j}" for j in range(40)) + " " * k) for k in range(300)]
    got = sketch_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), 4, 80).collect()
    assert all(r.n_shingles == 37 and r.component_id == 0 and r.kept == (r.doc_id == 0) for r in got) and len(got) == 300


def test_texts_over_one_slice(spark):
    """A text of several megabytes that holds a passage at both ends, and another that has it once."""
    passage = " ".join(f"shared{k}" for k in range(120))
    body = " ".join(f"own{k}x" for k in range(260_000))
    rows = [(1, f"a{passage}b {body} c{passage}d"), (2, f"e {passage} f"), (3, body[: 1 << 20].replace("own", "mine"))]
    assert len(rows[0][1]) > 2 << 20
    n = len(passage.encode())
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df, width=400).collect()}
    assert got == {1: (len(rows[0][1]), 2 * n, 2), 2: (n + 4, n, 1), 3: (len(rows[2][1]), 0, 0)}
    # Of words, those at the ends of the passage differ where letters are joined to them.
    words = {r.doc_id: (r.n_words, r.n_removed) for r in cover_dedup.remove_passages(df, width=35).collect()}
    assert words == {1: (260_000 + 240, 2 * 118), 2: (122, 118), 3: (len(rows[2][1].split()), 0)}
