import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm import pack, prefix_tokens, shard, word_bpe

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = [*"ab 're'sT12.!  \n\t é漢 ́½٣\x1c\x85", "<|endoftext|>", "  ", "'ll", "don't", "\r\n", "İ", "Σ", " ", " word", "Ünder"]
DOCS = "doc_id long, text string"


def noise(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_counts_at_every_prefix():
    library, own = Tokenizer.from_file(BYTES), prefix_tokens.PrefixCounter(BYTES)
    for text in noise(1, 150):
        want = [len(library.encode(text[:p], add_special_tokens=False).ids) for p in range(1, len(text) + 1)]
        assert own.at_prefixes(text) == want
        assert own.total(text) == (want[-1] if want else 0)
        for limit in (0, 3, 9):
            assert own.cut(text, limit) == max((p + 1 for p, n in enumerate(want) if n <= limit), default=0)


def test_long_words_are_not_quadratic():
    own, text = prefix_tokens.PrefixCounter(BYTES), "abcdefgh" * 3000
    assert own.total(text) == len(Tokenizer.from_file(BYTES).encode(text).ids)


def test_token_counts(spark):
    rows = [(1, "hello world " * 400), (2, None), (3, ""), (1, "hello world " * 400), (None, "x")]
    df = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("clash"))
    got = sorted(map(tuple, prefix_tokens.token_counts(df, BYTES, limit=100).collect()), key=str)
    n = len(Tokenizer.from_file(BYTES).encode(rows[0][1]).ids)
    cut = prefix_tokens.PrefixCounter(BYTES).cut(rows[0][1], 100)
    assert got == sorted([(1, 4800, n, True, cut), (1, 4800, n, True, cut), (2, 0, 0, False, 0), (3, 0, 0, False, 0), (None, 1, 1, False, 1)], key=str)
    assert prefix_tokens.token_counts(df.limit(0), BYTES).count() == 0
    assert prefix_tokens.prefix_counts(df.filter("doc_id = 1").limit(1), BYTES).first().prefix_tokens[-1] == n
    assert len(prefix_tokens.truncated(df.filter("doc_id = 1").limit(1), BYTES, 100).first().text) == cut


LATIN = "aAbBéÉßöÖñ ÷×'stREvemLLd0019!?$%&\n\t«»¿¡£§\x0b\x0c\r~`@"


def test_word_ids_equal_the_library():
    rnd = random.Random(12)
    library = Tokenizer.from_file(WORDS)
    texts = noise(2, 400) + [" a b", "", "a" * 5000 + " b", "!" * 300 + "'s", "x<|endoftext|>y", "I'M HERE'S we'LL", "aaaaaaa bbbbbbbbb abababab", "é" * 70, "\x00 a\x00b"]
    texts += ["".join(rnd.choice(LATIN) for _ in range(rnd.randint(0, 90))) for _ in range(4000)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for memo in (10, 200_000):
        own = word_bpe.WordEncoder(WORDS, memo)
        assert own.known
        got = [ids.tolist() for k in range(0, len(texts), 500) for ids in own.ids(texts[k : k + 500])]
        assert got == want
    own.known = False  # a vocabulary of another kind is left to the library
    assert [ids.tolist() for ids in own.ids(texts[:500])] == want[:500]


def shortest_pack_first(histogram, window):
    """Packs, by placing one piece at a time, longest first, into the pack with the most room."""
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            if rooms and -rooms[0] >= length:
                heapq.heapreplace(rooms, rooms[0] + length)
            else:
                heapq.heappush(rooms, length - window)
    return len(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_one_piece_at_a_time(seed):
    rnd = random.Random(seed)
    window = rnd.choice([64, 100, 4096])
    histogram = {rnd.randint(1, window): rnd.choice([1, 3, rnd.randint(1, 400)]) for _ in range(rnd.randint(1, 40))}
    assert abs(sum(packs for _, packs in pack.plan(histogram, window)) - shortest_pack_first(histogram, window)) <= 1


@pytest.mark.parametrize("histogram", [{3000: 1, 1100: 100_000}, {4000: 1, 100: 100_000}, {3000: 5, 600: 100_000}, {100: 50}])
def test_plan_opens_no_pack_in_vain(histogram):
    assert abs(sum(packs for _, packs in pack.plan(histogram, 4096)) - shortest_pack_first(histogram, 4096)) <= 1


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_length(seed):
    rnd = random.Random(seed)
    histogram = {rnd.randint(1, 64): rnd.randint(1, 50) for _ in range(rnd.randint(0, 12))}
    placed = Counter()
    for items, packs in pack.plan(histogram, 64):
        assert packs > 0 and sum(n * k for n, k in items) <= 64
        for n, k in items:
            placed[n] += k * packs
    assert placed == Counter(histogram)


@pytest.mark.parametrize(("hot", "n"), [(300, 10_000), (60, 200_000), (1500, 10_000)])
def test_plan_fills_packs_with_a_hot_length(hot, n):
    rnd = random.Random(hot)
    histogram = Counter(min(4095, max(1, int(rnd.lognormvariate(6, 1.2)))) for _ in range(20_000))
    histogram[hot] += n
    least = -(-sum(k * v for k, v in histogram.items()) // 4096)
    # Of 1500 tokens, two fit in a window: pieces of that length alone can't fill it.
    fewest = max(least, n // (4096 // hot))
    assert sum(packs for _, packs in pack.plan(histogram, 4096)) <= 1.02 * fewest
    assert sum(packs for _, packs in pack.plan({4000: 1, 60: 1000}, 4096)) == 16


def test_pack(spark):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choice(["one", "two", "three"]) for _ in range(rnd.randint(0, 300)))) for k in range(120)]
    rows += [(200, None), (201, ""), rows[3], (3, "other"), (None, "x y")]
    got = pack.pack(spark.createDataFrame(rows, DOCS).withColumn("length", F.lit(1)), WORDS, window=64).collect()
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for s in range(0, len(ids), 64):
            want[doc, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(sequences) == list(range(len(sequences)))
    assert pack.pack(spark.createDataFrame([], DOCS), WORDS).count() == 0


def test_shards_match_the_mixture(spark):
    rows = [(k, "x" * (k % 7), "hot" if k % 3 else f"s{k % 4}") for k in range(5000)] + [(7, None, None), (7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("shard", F.lit("clash"))
    got = shard.stratified_shards(df, 24).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    source = {k: s for k, _, s in rows}
    sizes, per = Counter(s for _, _, s in rows), Counter((source[r.doc_id], r.shard) for r in got)
    for name, n in sizes.items():
        # Each source is less than one row off its share at any place, and a cut moves by what all are off together.
        assert all(abs(per[name, k] - n / 24) < 1 + n / len(rows) * (len(sizes) + 1) for k in range(24))
    assert all(r.text_crc32 == zlib.crc32(b"x" * (r.size - 8)) for r in got)
    again = shard.stratified_shards(df.repartition(7), 24).select("doc_id", "shard", "slot").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.shard, r.slot) for r in got)
    few = shard.stratified_shards(df.limit(3), 24).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0]
    assert shard.stratified_shards(df.limit(0), 24).count() == 0


def test_shards_by_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([k, k, k, None, 7]), rnd.choice([None, "", "é" * (k % 5), "same"]), rnd.choice(["a", "a", "a", "b", None])) for k in range(700)]
    crc, size = (lambda t: zlib.crc32((t or "").encode())), (lambda t: len((t or "").encode()) + 8)
    h60 = lambda *x: int(hashlib.md5("|".join(["17", *("" if v is None else str(v) for v in x)]).encode()).hexdigest()[:15], 16)
    strata = defaultdict(list)
    for d, t, s in rows:
        strata["" if s is None else f"={s}"].append((h60(d, crc(t)), d is not None, d or 0, crc(t), size(t)))
    order = []
    for name, some in strata.items():
        phase = h60(name) / 2.0**60
        order += [((k + phase) / len(some), name, *cell) for k, cell in enumerate(sorted(some))]
    want = Counter()
    base, more = divmod(len(rows), 24)
    cuts = [k * base + min(k, more) for k in range(25)]
    for place, (*_, there, d, c, n) in enumerate(sorted(order)):
        k = max(j for j in range(24) if cuts[j] <= place)
        want[d if there else None, n, c, "rows", k, place - cuts[k], None] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    assert Counter(map(tuple, shard.stratified_shards(df, 24).collect())) == want
