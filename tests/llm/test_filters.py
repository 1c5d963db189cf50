import math
import random
import re
import time
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from quillspark.llm import chat, decontaminate, licenses, oracles, quality

DOCS = "doc_id long, text string, lang string"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed)


def test_base_counts(spark):
    texts = [None, "", " \n\t", "a b c d a b c", "x " * 70, "l1\nl1\n \nl2\nl1", "é漢 #*$%&|<>", "\x0b\x1cw\xa0v", "a b c a b c a b " * 20 + "end", " ".join(map(str, range(80)))]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], DOCS).withColumn("n_words", F.lit("clash"))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: tuple(r)[1:] for r in quality.quality_rules(df, labels).collect()}
    assert got == {k: (*base(t), not base(t)[5]) for k, t in enumerate(texts)}
    assert quality.quality_rules(df.limit(0), labels).count() == 0


@pytest.mark.parametrize(("n", "risk", "error"), [(100, 0.05, 0.01), (1000, 0.0125, 0.003), (50, 0.01, 0.01), (0, 0.05, 0.05), (5000, 0.02, 1e-4)])
def test_exact_bound(spark, n, risk, error):
    p, total, want = Fraction(risk), Fraction(0), -1
    for k in range(n + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > error:
            break
        want = k
    got = spark.range(1).select(quality.most_false(F.lit(n).cast("long"), risk, F.lit(error)).alias("k")).first().k
    assert got == want


def test_certified_cutoffs(spark):
    clean = [(k, " ".join(f"w{k}x{j}" for j in range(60)), "en") for k in range(800)]
    junk = [(1000 + k, " ".join(f"v{k}x{j}" + "###" * (j % 2) for j in range(60)), "en") for k in range(80)]
    few = [(2000 + k, " ".join(f"v{k}x{j}###" for j in range(60)), "xx") for k in range(20)]
    labels = spark.createDataFrame([(d, 1 if d < 1000 else 0) for d, _, _ in [*clean, *junk[:40], *few]] + [(None, 1), (5, None)], "doc_id long, quality int")
    df = spark.createDataFrame([*clean, *junk, *few], DOCS)
    kept = {r.doc_id: r.kept for r in quality.quality_rules(df, labels, delta=0.2).collect()}
    assert all(kept[d] for d, _, _ in clean)
    assert not any(kept[d] for d, _, _ in junk)  # also the unlabelled
    assert all(kept[d] for d, _, _ in few)  # no good documents there: nothing can be certified
    rows = quality.quality_rules(df, labels, delta=0.2, with_row=True).filter("kept").select("row.*")
    assert rows.columns == df.columns and rows.count() == len(clean) + len(few)


def test_chats(spark):
    a = [("user", "hi"), ("assistant", "yes"), ("user", "go")]
    chats = {1: a[:1], 2: a[:2], 3: a, 4: a, 5: [("user", "hi"), ("assistant", "no")], 6: [("user", None)], 7: [("user", "yes"), ("assistant", "hi")]}
    rows = [(c, t, r, x) for c, turns in chats.items() for t, (r, x) in enumerate(turns)] + [(None, 0, "user", "lone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("clash")).repartition(4)
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(df).collect()}
    render = lambda turns: "".join(f"<|im_start|>{r}\n{x or ''}<|im_end|>\n" for r, x in turns)
    assert got == {3: (3, 2, render(a)), 5: (2, 1, render(chats[5])), 6: (1, 1, render(chats[6])), 7: (2, 1, render(chats[7])), None: (1, 1, render([("user", "lone")]))}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_turns_that_one_hash_takes_for_one(spark):
    c = "c" * 24
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", f"aaaaaaaa{c}bbbbbbbb{c}"), (2, 0, "user", "hi"), (2, 1, "assistant", f'ubthmiig{c}r"]4M+;.{c}'), (2, 2, "user", "go on")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(r.conv_id for r in got) == [1, 2]


def test_chats_with_ties_repeats_and_long_texts(spark):
    long = "word " * 200_000
    rows = [(1, 0, "user", "a"), (1, 0, "assistant", "b"), (2, 0, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "user", long), (3, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, "user", "x"), (5, None, "user", "x|1"), (5, 1, "user|1", "x")]
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {2: (3, 1), 3: (2, 1), 5: (2, 1)}


def test_key_words_lose_no_unit():
    grams = lambda t: (lambda w: list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:]))))(re.sub("[^a-z0-9]+", " ", t.lower()).split())
    some = [g for _, t in licenses.templates() if (g := grams(t))]
    for least in (0.6, 0.8, 1.0):
        keys = licenses.key_words(some, least)
        pattern = re.compile(licenses._pattern(keys))
        for g in some:
            # What is left of a template without any key word is too little for `least`.
            rest = [x for x in g if keys.isdisjoint(x.split(" "))]
            assert 2 * len(rest) / (len(g) + len(rest)) < least
        text = " ".join(sorted(keys))
        assert pattern.findall(text) == sorted(keys)
        assert not pattern.search(" ".join(f"x{w} {w}x" for w in sorted(keys)))


def test_license_ties_and_long_texts(spark):
    known = [("B", "one two three four"), ("A", "one two three four")]
    rows = [(1, "one two three four"), (2, "filler words here " * 100_000 + "\none two three four")]
    got = sorted((r.doc_id, r.place, r.license) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), known=known).filter("unit = 'line'").collect())
    assert got == [(1, 0, "A"), (2, 1, "A")]
    assert licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), known=[]).count() == 0


def test_licenses(spark):
    mit = licenses.TEXTS[0][1]
    rows = [(1, "text\nReleased under the MIT License.\nmore"), (2, None), (3, ""), (4, "the License of the lake under which it was released"), (5, mit), (6, "intro line\n\n" + mit.replace(" of ", " of\n") + "\n\nend"), (1, "text\nReleased under the MIT License.\nmore"), (7, "LICENSED under CC BY-NC 4.0")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = sorted((r.doc_id, r.unit, r.place, r.license, r.dice) for r in licenses.license_scan(df).collect())
    assert got == [(1, "line", 1, "MIT", 1.0), (5, "line", 0, "MIT", 1.0), (6, "paragraph", 1, "MIT", 1.0), (6, "text", 0, "MIT", 0.981595), (7, "line", 0, "CC-BY-NC-4.0", 1.0)]
    assert licenses.license_scan(df.limit(0)).count() == 0


def test_licence_texts_and_notices_inside_lines(spark):
    names = dict(licenses.NAMES)
    assert {spdx for spdx, _ in licenses.PARAGRAPHS} >= set(names) - {"ISC"}
    rows = [(k, f"head\n\n{text}\n\nend") for k, (_, text) in enumerate(licenses.PARAGRAPHS)]
    rows += [(-1, "A long sentence stands in front of this one here. Released under the MIT License. And one more stands behind it, as long."), (-2, "No notice. None here.")]
    got = {}
    for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).filter("unit in ('line', 'sentence')").collect():
        got.setdefault(r.doc_id, set()).add((r.unit, r.license, r.dice))
    for k, (spdx, _) in enumerate(licenses.PARAGRAPHS):
        assert ("line", spdx, 1.0) in got[k]
    assert got[-1] == {("sentence", "MIT", 1.0)} and -2 not in got


def test_license_scan_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    grams = lambda t: (lambda w: set(zip(w, w[1:])))(re.sub("[^a-z0-9]+", " ", t.lower()).split())
    known = [(spdx, grams(t)) for spdx, t in licenses.templates()]
    want = set()
    for r in docs.collect():
        for k, line in enumerate(r.text.split("\n")):
            g = grams(line)
            best = max(((2 * len(g & t) / (len(g) + len(t)), spdx) for spdx, t in known if g), default=(0, ""))
            if best[0] >= 0.8:
                want.add((r.doc_id, k))
    assert {(r.doc_id, r.place) for r in licenses.license_scan(docs).filter("unit = 'line'").collect()} == want


QUESTION = "so Alice has 12 apples and buys 7 more, then walks 3 km to the market. How many apples does Alice have now?"


def test_decontamination(spark):
    again = "Ok, then Robert has 15 apples and buys 9 more, then walks 8 km to the market. How many apples does Robert have now?"
    rows = [
        (1, "Intro here. " + QUESTION + " The end."),
        (2, again),
        (3, again.replace("does Robert", "does Conrad")),
        (4, None),
        (5, ""),
        (6, "An unrelated text about the walk to a lake, with 12 birds and 7 boats on it, and some more words after."),
        (7, "tiny item"),
        (8, "so Alice has 12 apples and leaves."),
        (1, "Intro here. " + QUESTION + " The end."),
        (None, QUESTION),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(9, QUESTION), (10, "Tiny item"), (11, None), (12, "")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()), key=str)
    assert got == sorted([(1, 9), (2, 9), (7, 10), (None, 9)], key=str)
    left = [r.doc_id for r in decontaminate.uncontaminated(df, bench).collect()]
    assert sorted(left) == [3, 4, 5, 6, 8]
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def leaks(spark, texts, items):
    """(doc, item, n_windows, n_matched) of texts and items, both numbered from 0."""
    docs, bench = (spark.createDataFrame(list(enumerate(rows)), f"{c} long, text string") for c, rows in (("doc_id", texts), ("item_id", items)))
    return sorted((r.doc_id, r.item_id, r.n_windows, r.n_matched) for r in decontaminate.contaminated(docs, bench).collect())


def test_items_with_words_put_in_or_left_out(spark):
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    one, two = [*words[:20], "new", *words[20:]], [*words[:14], "new", *words[14:27], "new", *words[27:]]
    less, far = words[:19] + words[20:], [*words[:20], *["new"] * 60, *words[20:]]
    got = leaks(spark, [" ".join(["intro", *w, "end"]) for w in (words, one, two, less, far, words[:20])], [" ".join(words)])
    assert got == [(0, 0, 33, 33), (1, 0, 33, 26), (2, 0, 33, 19), (3, 0, 33, 25)]


def test_names_by_the_word_and_plain_copies(spark):
    sum_ = "Alice has 3 apples. Bob gives her 5 more. How many apples does Alice have now?"
    met = "the man met Alice and then Bob went home with Carol and saw Dave"
    texts = [sum_.replace("Alice", "Robert").replace("Bob", "Conrad").replace("3", "8").replace("5", "9"), met.replace(" Alice", "\nAlice").replace(" Bob", "\r\nBob").replace(" Carol", "\tCarol"), met.lower(), "see Tiny item here", "see tiny item here", "(Alice) and 'Bob' met"]
    got = leaks(spark, texts, [sum_, met, "Tiny item here", "Conrad and Dora met"])
    assert got == [(0, 0, 9, 9), (1, 1, 7, 7), (2, 1, 7, 7), (3, 2, 1, 1), (4, 2, 1, 1), (5, 3, 1, 1)]


def test_equal_fillers_need_no_plain_words(spark):
    title, sums, table = "Great Northern Railway Timetable Summer Season Edition Nineteen Twelve London", "What is 12 + 7 - 3 * 4 + 9?", "12 km 7 kg 3 km 14 kg 5 km 6 kg"
    other = "Small Southern Canal Pricelist Winter Months Reprint Eighteen Eleven Paris"
    got = leaks(spark, [f"see {title} there", f"{sums} Yes.", f"row {table} row", other, "9 km 8 kg 4 km 11 kg 2 km 3 kg"], [title, sums, table])
    assert [g[:2] for g in got] == [(0, 0), (1, 1), (2, 2)] and all(g[2] == g[3] for g in got)


def test_fillers_of_an_item_may_become_equal(spark):
    pens = "so the shop on the corner sold {} red pens and {} blue pens to the same people before lunch today"
    texts = [pens.format(14, 14), pens.format(14, 16), pens.format(12, 15)]
    assert leaks(spark, texts, [pens.format(12, 15)]) == [(0, 0, 14, 14), (1, 0, 14, 14), (2, 0, 14, 14)]
    # Equal ones of the item must stay equal.
    assert leaks(spark, [texts[1]], [pens.format(12, 12)]) == []


def test_places_of_windows(spark):
    words, sizes = ["a", "b", "a", "c", "d"], [2, 3, 7]
    df = spark.createDataFrame([(words, [w.upper() for w in words])], "w array<string>, t array<string>")
    both = F.posexplode(F.concat(decontaminate.window_hashes(F.col("w"), sizes), decontaminate.window_hashes(F.col("t"), sizes)))
    got = df.select(both.alias("at", "h")).collect()
    for typed, name in ((False, "w"), (True, "t")):
        for n in sizes:
            want = [(c.p, c.h) for c in df.select(F.explode(decontaminate.windows(F.col(name), [n])).alias("c")).select("c.*").collect()]
            at = decontaminate.place(F.col("at"), F.lit(5), F.lit(n), F.lit(typed), sizes)
            assert [(r.p, r.h) for r in spark.createDataFrame(got, "at int, h long").select(at.alias("p"), "h").filter("p is not null").collect()] == want


def test_windows_of_any_size(spark):
    words = [f"w{k}" for k in range(12)] + [f"w{k}" for k in range(12)]
    for n in (1, 2, 3, 5, 8, 12):
        df = spark.createDataFrame([(words,)], "w array<string>")
        cells = df.select(F.explode(decontaminate.windows(F.col("w"), [n])).alias("c")).select("c.*").collect()
        assert len(cells) == 25 - n
        seen = {}
        for c in cells:
            assert seen.setdefault(tuple(words[c.p : c.p + n]), c.h) == c.h
        assert len(set(seen.values())) == len(seen)




def cutoffs(scored, risk, delta):
    """stratum -> rule -> cutoff level: every cutoff's test by exact fractions, one after the other from the loosest."""
    strata, rules = sorted({s for s, _, _ in scored}), list(quality.RULES)
    out = {}
    for s in strata:
        for k, rule in enumerate(rules):
            good = [levels[k] for t, g, levels in scored if t == s and g]
            bad = [levels[k] for t, g, levels in scored if t == s and not g]
            p, best, gain = Fraction(risk) / len(rules), None, Fraction(0)
            for level in range(quality.LEVELS, 0, -1):
                false = sum(x >= level for x in good)
                tail = sum(Fraction(math.comb(len(good), j)) * p**j * (1 - p) ** (len(good) - j) for j in range(false + 1))
                if tail > Fraction(delta) / (len(rules) * len(strata)):
                    break
                now = Fraction(sum(x >= level for x in bad), max(1, len(bad))) - Fraction(false, len(good))
                if now > gain:
                    best, gain = level, now
            out[s, rule] = best
    return out


def test_cutoffs_by_brute_force(spark):
    rnd = random.Random(5)
    rows, labels = [], {}
    for k in range(900):
        good, lang = k % 3 > 0, "ab"[k % 2]
        words = [f"w{k}x{j}" for j in range(60)]
        for _ in range(rnd.choice([0, 0, 0, 1, 2]) if good else rnd.choice([0, 3, 9, 20])):
            words[rnd.randrange(60)] += rnd.choice(["#", "%%", "A", "Q Q Q Q"])
        text = " ".join(words) + "\nagain\n" * (rnd.choice([0, 0, 1]) if good else rnd.choice([0, 2, 30]))
        rows.append((k, text, lang))
        labels[k] = int(good)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    gold = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    counts = quality.metrics(df)
    scored = []
    for r in counts.collect():
        if r.n_words >= 50 and 100 * r.n_repeat_words <= 50 * r.n_words:
            share = [Fraction(r.n_symbols, r.n_words), Fraction(r.n_repeat_words, r.n_words), Fraction(r.n_dup_lines, max(1, r.n_lines)), Fraction(r.n_upper, r.word_chars)]
            scored.append((r.stratum, labels[r.doc_id], [min(quality.LEVELS, math.floor(x * quality.LEVELS)) for x in share]))
    for risk, delta in ((0.2, 0.2), (0.4, 0.05)):
        want = cutoffs(scored, risk, delta)
        got = {(r.stratum, rule): r[rule] for r in quality.thresholds(counts, gold, risk, delta).collect() for rule in quality.RULES}
        assert got == want
        assert any(v is not None for v in got.values())


def test_rules_with_null_ids_and_strata(spark):
    text = " ".join(f"w{j}" for j in range(60))
    rows = [(None, text, None), (1, text, None), (1, text, None), (2, "w " * 200_000, "en")]
    got = quality.quality_rules(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")).collect()
    assert sorted(((r.doc_id, r.n_words, r.kept) for r in got), key=str) == sorted([(None, 60, True), (1, 60, True), (1, 60, True), (2, 200_000, False)], key=str)


def typed(text):
    """(plain words, template words) of a text, word by word."""
    outer, raw, words = decontaminate.OUTER, [], []
    bare = text.strip(outer + " \t\n\x0b\f\r")
    for token in re.split(r"[\x20\x09-\x0d]+", bare) if bare else []:
        word = token.strip(outer)
        # A sign before a number belongs to it, and so do marks at its end.
        number = re.fullmatch(rf"[{re.escape(outer)}]*?[$€£]?[0-9][0-9.,:/-]*%?[{re.escape(outer)}]*", token)
        name = re.fullmatch(r"[A-ZÄÖÜÉ][a-zäöüßéñ][\w'-]*", word) and word not in decontaminate.COMMON
        raw.append(word.lower())
        if number and word:
            words.append(decontaminate.NUMBER)
        elif words and words[-1] == decontaminate.NUMBER and word in decontaminate.UNITS:
            words.append(decontaminate.UNIT)
        else:
            words.append(decontaminate.NAME if name else word.lower())
    return raw, words


def leak(text, item, size=8, coverage=0.5):
    """(windows, matched) of the best band in which text holds item, by comparing every place with every place; None if none does."""
    (ours, our_words), (theirs, their_words) = typed(text), typed(item)
    n = min(size, len(theirs))
    if not n:
        return None
    windows, need = len(theirs) - n + 1, math.ceil(coverage * (len(theirs) - n + 1))
    at = lambda words, p: words[p : p + n]
    runs = {}
    for q in range(windows):
        for p in range(len(ours) - n + 1):
            if at(ours, p) == at(theirs, q) or at(our_words, p) == at(their_words, q):
                runs.setdefault(p - q, set()).add(q)

    def bands(runs):
        out, last = [], None
        for shift in sorted(runs):
            if last is None or shift - last > windows + n - 1:
                out.append({})
            out[-1][shift] = runs[shift]
            last = shift
        return [b for b in out if len(set().union(*b.values())) >= need]

    sound = {}
    for band in bands(runs):
        for shift, qs in band.items():
            cover = sorted({k for q in qs for k in range(q, q + n)})
            slots = {(their_words[k], theirs[k], ours[k + shift]) for k in cover if their_words[k] in "\x01\x02\x03"}
            plain = sum(their_words[k] not in "\x01\x02\x03" for k in cover)
            if 2 * plain < len(cover) or len(slots) != len({s[:2] for s in slots}):
                qs = {q for q in qs if at(ours, q + shift) == at(theirs, q)}
            if qs:
                sound[shift] = qs
    best = max((len(set().union(*b.values())) for b in bands(sound)), default=0)
    return (windows, best) if best else None


def test_leaks_by_brute_force(spark):
    rnd = random.Random(9)
    vocabulary = ["the", "walks", "to", "market", "and", "buys", "apples", "with", "red", "pens", "for", "how", "many", "does", "have", "now", "said"]
    names, units = ["Alice", "Bob", "Carol", "Dave", "Emma"], ["km", "kg", "hours", "days"]

    def sentence(n):
        out = []
        while len(out) < n:
            kind = rnd.random()
            out += [rnd.choice(names)] if kind < 0.15 else [str(rnd.randint(2, 40)), rnd.choice(units)] if kind < 0.3 else [rnd.choice(vocabulary)]
        return out

    items = [sentence(rnd.choice([3, 8, 9, 14, 25, 40])) for _ in range(12)]
    texts = []
    for _ in range(70):
        words = list(rnd.choice(items))
        change = dict(zip(names, rnd.sample(names, len(names)))) if rnd.random() < 0.5 else {}
        words = [change.get(w, str(int(w) + 3) if w.isdigit() and change else w) for w in words]
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            k = rnd.randrange(len(words) + 1)
            words[k : k + rnd.randint(0, 1)] = sentence(1)[:1]
        text = " ".join(sentence(rnd.randint(0, 12)) + words + sentence(rnd.randint(0, 12)))
        if rnd.random() < 0.2:
            text = text.lower() if rnd.random() < 0.5 else text.upper()
        texts.append(rnd.choice(["", "(", "“"]) + text.replace(" and ", ", and ") + rnd.choice([".", "?!", "", "”"]))
    plain = lambda t: t.translate(str.maketrans(decontaminate.TYPOGRAPHIC, decontaminate.PLAIN_MARKS))
    want = sorted((i, j, *found) for i, t in enumerate(texts) for j, item in enumerate(items) if (found := leak(plain(t), " ".join(item))))
    assert leaks(spark, texts, [" ".join(i) for i in items]) == want
    assert len(want) > 30


def test_leak_ties_and_long_texts(spark):
    item = "so the shop on the corner sold twelve red pens and fifteen blue pens to the same people"
    long = "word " * 150_000 + item
    assert [g[:2] for g in leaks(spark, [long, f"{item} {item}", item], [item, item])] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1)]


def test_license_sql_finds_what_spark_finds(spark):
    db = duckdb.connect()
    long = "A long sentence stands in front of this one here."
    texts = [f"{long} Then another one stands. Released under the MIT License. And one more stands behind it, as long.", "x\nReleased under the MIT License.\n", f'{long} "Licensed under CC BY-NC 4.0." {long}', f"head\n\n{licenses.TEXTS[0][1]}\n\nend", f"{long} Released under the MIT License!) Released under the MIT License.", "No notice. None here.", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    db.register("documents", df.toPandas())
    want = sorted((d, u, p, n, round(x, 6)) for d, u, p, n, x in db.execute(f"SELECT doc_id, unit, place, license, dice FROM ({oracles.OP8})").fetchall())
    got = sorted((r.doc_id, r.unit, r.place, r.license, round(r.dice, 6)) for r in licenses.license_scan(df).collect())
    assert got == want and {r[1] for r in got} == {"line", "sentence", "text"} or {r[1] for r in got} >= {"line", "sentence"}
    assert (0, "sentence", 2, "MIT", 1.0) in got


def test_an_item_that_one_text_repeats(spark):
    item = "the quick river turned seven bright stones while Anna counted 12 small boats near old mills"
    docs = spark.createDataFrame([(1, " ".join([item] * 5000)), (2, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    start = time.monotonic()
    got = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    assert [r[:4] for r in got] == [(1, 5, got[1][2], got[1][2]), (2, 5, got[1][2], got[1][2])]
    assert time.monotonic() - start < 200
