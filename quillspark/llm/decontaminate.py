"""Benchmark decontamination by template windows.

Words become template words: numbers, names (capitalised words, but for common ones that start
sentences) and units after a number are typed placeholders, everything else is lower-cased without
outer punctuation. Windows of template words, and of plain lower-cased ones, are hash-joined with those
of the benchmark. A document and an item that share windows along shifts close to each other are then
checked word by word: along each shift, each filler of the item must have one filler in the document, so
a question with other numbers or names is caught while a chance meeting of placeholders is not.
DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch, let

# Units that count after a number, what is cut from the ends of a word, and the placeholders.
UNITS = "mm cm m km mg g kg t ml l s ms min h hours minutes seconds days weeks months years % $ € £ dollars euros pounds cents miles feet inches metres meters litres liters grams kilograms kilometres kilometers percent degrees people".split()
OUTER = "!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~«»¿¡·"
# Typographic marks, and the plain ones that stand for them. Classes of Latin-1 marks alone are table lookups.
TYPOGRAPHIC = "‹›“”„‘’‚…–—•"
PLAIN_MARKS = "<>\"\"\"'''.--*"
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"

BLANK = "[\\x20\\x09-\\x0D]"
OUTER_CLASS = "[" + "".join("\\" + c if ord(c) < 128 else c for c in OUTER) + "]"
#: Words are parted at blanks, together with the punctuation at their ends.
GAP = f"{OUTER_CLASS}*{BLANK}+{OUTER_CLASS}*"
ENDS = f"(?={OUTER_CLASS}*(?:{BLANK}|$))"
#: Words that sentences start with and that are no names, in the corpus's languages.
COMMON = (
    "A About After All Also Although An And Any Are Around As At Because Before Both But By Can Could Did Do Does During Each Every Find First For From Give Given Had Has Have He Her Here His How However I If In Is It Its Let Many More Most My No Not Now Of On One Only Or Our She Should Since So Some Such Than That The Their Then There These They This Those Three Through To Two Under Until Was We Were What When Where Which While Who Whose Why With Without Would You Your "
    "Aber Als Am Auch Auf Aus Bei Da Das Dem Den Der Des Die Dies Diese Dieser Ein Eine Einem Einen Einer Er Es Für Hat Ich Ihr Im Ist Jede Jeder Kann Man Mit Nach Nicht Noch Nur Oder Sie Sind So Und Unter Von Vor Wann Warum Was Welche Wenn Wer Wie Wir Wird Wo Zu Zum Zur "
    "Al Algunos Como Cómo Con Cuando Cuándo Cuál Cuánto Cuántos De Del Después Dónde El Ella En Entre Era Es Esta Este Esto Hay La Las Los Más No Para Pero Por Porque Que Qué Quién Se Según Si Sin Sobre Su Sus También Todo Todos Un Una Y Ya "
    "À Au Aux Avec Ce Ces Cette Chaque Comme Comment Combien Dans Des Du Elle Et Il Ils Je Le Les Leur Mais Nous On Où Ou Par Pour Pourquoi Quand Quel Quelle Qui Sa Ses Son Sur Tous Tout Une Vous"
).split()
#: A capitalised word that is none of these, wherever it stands.
NAME_AT = f"({BLANK}{OUTER_CLASS}*+)((?=\\p{{Lu}}\\p{{Ll}})(?!(?:" + "|".join(sorted(set(COMMON))) + f")(?![\\p{{L}}\\p{{N}}'-]))[\\p{{L}}\\p{{N}}'-]++){ENDS}"
NUMBER_AT = f"(?<={BLANK}|^|{OUTER_CLASS})([$€£]?[0-9][0-9.,:/-]*%?){ENDS}"
UNIT_AT = f"({NUMBER}[$€£]?[0-9][0-9.,:/-]*+%?+{OUTER_CLASS}{{0,3}}{BLANK})(" + "|".join(u.replace("$", "\\$") for u in UNITS) + f"){ENDS}"

#: Benchmark windows up to which they are broadcast; beyond, both sides are shuffled by hash.
BROADCAST_ROWS = 2_000_000


def usual(text: Column) -> Column:
    """text with plain marks instead of typographic ones."""
    return F.when(text.rlike("[‐-›]"), F.translate(text, TYPOGRAPHIC, PLAIN_MARKS)).otherwise(text)


def _split(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return let(F.btrim(text, F.lit(OUTER + SPACES)), lambda bare: F.when(bare == "", none).otherwise(F.split(bare, GAP)))


def marked_words(text: Column) -> Column:
    """Lower-cased words of a text without punctuation at their ends; numbers, names and units have their placeholder in front.

    Marks are put into the whole text before it is split: a few passes of a pattern over a text cost
    less than an expression per word. Texts without digits are spared two of them.
    """
    typed = lambda s: F.regexp_replace(F.regexp_replace(s, NUMBER_AT, NUMBER + "$1"), UNIT_AT, "$1" + UNIT + "$2")
    numbered = let(usual(F.coalesce(text, F.lit(""))), lambda s: F.when(s.rlike("[0-9]"), typed(s)).otherwise(s))
    return _split(F.lower(F.regexp_replace(F.concat(F.lit(" "), numbered), NAME_AT, "$1" + NAME + "$2")))


def _is_marked(word: Column) -> Column:
    return word < F.lit("\x04")


def plain(word: Column) -> Column:
    return F.when(_is_marked(word), F.substring(word, 2, 1 << 30)).otherwise(word)


def template(word: Column) -> Column:
    return F.when(_is_marked(word), F.substring(word, 1, 1)).otherwise(word)


def _hashed(words: Column, sizes: list[int], each, typed: str, kind=lambda w: w) -> Column:
    """each(hashes) of the windows of kind(word) of each size, in one array of the type named, smaller sizes first.

    Hashes of windows of 2, 4, 8, ... words come from two of half the size; other sizes from two
    that overlap.
    """

    def joined(h: Column, shift: int) -> Column:
        """Hashes of pairs `shift` apart."""
        n = F.size(h) - shift
        return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(F.zip_with(F.slice(h, 1, n), F.slice(h, shift + 1, n), lambda a, b: F.xxhash64(a, b)))

    def grow(h: Column, width: int) -> Column:
        here = [each(h if n == width else joined(h, n - width)).cast(typed) for n in sorted(sizes) if width <= n < 2 * width]
        if 2 * width <= max(sizes):
            here.append(let(joined(h, width), lambda g: grow(g, 2 * width)))
        return F.concat(*here) if len(here) > 1 else here[0]

    return let(F.transform(words, lambda w: F.xxhash64(kind(w))), lambda h: grow(h, 1))


def windows(words: Column, sizes: list[int]) -> Column:
    """(hash, place) of all windows of template words, of each size."""

    def placed(h: Column) -> Column:
        return F.transform(h, lambda x, p: F.struct(x.alias("h"), p.alias("p")))

    return _hashed(words, sizes, lambda h: let(h, placed), "array<struct<h:bigint,p:int>>")


def window_hashes(words: Column, sizes: list[int], kind=lambda w: w) -> Column:
    """Hashes of all windows, without their places: these follow from the number of words, see place()."""
    return _hashed(words, sizes, lambda h: h, "array<bigint>", kind)


def place(at: Column, n_words: Column, n: Column, typed: Column, sizes: list[int]) -> Column:
    """Where the window of n words at `at` starts, in window_hashes() of plain and, after these, of template
    words; null if no window of that size and kind is there."""
    count = lambda k: F.greatest(n_words - k + 1, F.lit(0))
    below = sum((F.when(n > k, count(k)).otherwise(0) for k in sizes), F.lit(0))
    p = at - below - F.when(typed, sum((count(k) for k in sizes), F.lit(0))).otherwise(0)
    return F.when((p >= 0) & (p < count(n)), p)


PAIR = ["doc_id", "text_hash", "item_id"]


def _bands(runs: DataFrame) -> DataFrame:
    """band: shifts of a document and an item, each at most the item's length from the next, are one band."""
    by_shift = Window.partitionBy(*PAIR).orderBy("shift")
    apart = F.col("shift") - F.lag("shift").over(by_shift) > F.col("n_windows") + F.col("n") - 1
    return runs.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("band", F.sum("apart").over(by_shift)).drop("apart")


def _whole(runs: DataFrame, coverage: float) -> DataFrame:
    """Runs of bands in which at least `coverage` of the item's windows are found, and n_matched, how many.

    A band is counted once and its count joined back: a text that repeats an item has very many runs in a band.
    """
    cells = runs.select(*PAIR, "n_windows", "band", F.explode("qs").alias("q"))
    found = cells.groupBy(*PAIR, "n_windows", "band").agg(F.count_distinct("q").alias("n_matched")).filter(F.col("n_matched") >= F.ceil(coverage * F.col("n_windows")))
    found = found.select(*(F.col(c).alias(f"_{c}") for c in [*PAIR, "band"]), "n_matched")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("item_id").eqNullSafe(F.col("_item_id")) & (F.col("text_hash") == F.col("_text_hash")) & (F.col("band") == F.col("_band"))
    return runs.join(found, same).select(*runs.columns, "n_matched")


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 8, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, n_slots of each document and item it holds in whole or large part;
    with_hash adds xxhash64 of the text.

    A match is a band of shifts between document and item, each at most the item's length from the
    next, along which together at least `coverage` of the item's windows of `size` words agree, as
    template or as plain words (shorter items: one window, the item). A word put in or left out starts
    another shift. Along each shift, half the matched words at least must be no placeholders, and a
    filler of the item must have one filler in the document, which others may share; else only windows
    that are equal word for word count. Of several bands of a pair the best counts. Null and empty
    texts match nothing; null ids are kept;
    repeated rows give one row per (id, text). Items with equal texts match each. Texts are read whole, of
    any length. An empty table or benchmark gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    both_kinds = [F.transform("marked", plain).alias("raw"), F.transform("marked", template).alias("words")]
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    items = scratch.write(items.select("item_id", marked_words(F.col("text")).alias("marked")).select("item_id", *both_kinds).filter(F.size("words") > 0), "items")
    sizes = sorted(r.n for r in items.select(F.least(F.size("words"), F.lit(size)).alias("n")).distinct().collect()) or [size]
    # Windows of plain words, and those of template words that differ from them.
    windows_of = lambda n: F.arrays_zip(windows(F.col("raw"), [n]).alias("plain"), windows(F.col("words"), [n]).alias("typed"))
    cells = items.select("item_id", F.size("words").alias("len"), F.explode(F.array(*[F.struct(F.lit(n).alias("n"), windows_of(n).alias("c")) for n in sizes])).alias("s"))
    cells = cells.filter(F.col("s.n") == F.least(F.col("len"), F.lit(size))).select("item_id", "s.n", (F.col("len") - F.col("s.n") + 1).alias("n_windows"), F.explode("s.c").alias("c"))
    kinds = F.array(F.struct(F.lit(False).alias("typed"), F.col("c.plain.h").alias("h")), F.struct(F.lit(True).alias("typed"), F.col("c.typed.h").alias("h")))
    cells = cells.select("item_id", "n", "n_windows", F.col("c.plain.p").alias("q"), F.explode(kinds).alias("k"), F.col("c.plain.h").alias("plain"))
    cells = cells.filter(~F.col("k.typed") | (F.col("k.h") != F.col("plain"))).select("item_id", "n", "n_windows", "q", "k.typed", "k.h")
    cells = scratch.write(cells, "cells")
    few_cells = cells.count() <= BROADCAST_ROWS

    # Documents with any window of the benchmark; only these are looked at window by window.
    whole = F.col(text_col).cast("string")
    texts = docs.filter(whole.isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.alias("text"))
    hashes = let(marked_words(F.col("text")), lambda w: F.concat(window_hashes(w, sizes, plain), window_hashes(w, sizes, template)))
    known = cells.select("h").distinct()
    near = texts.select("doc_id", "text_hash", F.explode(hashes).alias("h")).join(F.broadcast(known) if few_cells else known, "h", "left_semi")
    near = scratch.write(near.select("doc_id", "text_hash").distinct(), "near")
    near = F.broadcast(near) if near.count() <= BROADCAST_ROWS // 10 else near
    near = near.select(F.col("doc_id").alias("near_id"), F.col("text_hash").alias("near_hash"))
    split = texts.join(near, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_hash") == F.col("near_hash")), "left_semi")
    split = split.select("doc_id", "text_hash", marked_words(F.col("text")).alias("marked")).select("doc_id", "text_hash", *both_kinds)
    split = scratch.write(split.dropDuplicates(["doc_id", "text_hash"]), "split")
    probe = split.select("doc_id", "text_hash", F.size("raw").alias("n_words"), F.posexplode(F.concat(window_hashes(F.col("raw"), sizes), window_hashes(F.col("words"), sizes))).alias("at", "h"))
    hits = probe.join(F.broadcast(cells) if few_cells else cells, "h").withColumn("p", place(F.col("at"), F.col("n_words"), F.col("n"), F.col("typed"), sizes)).filter("p is not null")
    runs = (
        hits.groupBy(*PAIR, "n", "n_windows", (F.col("p") - F.col("q")).alias("shift"))
        .agg(F.sort_array(F.collect_set("q")).alias("qs"))
    )
    runs = scratch.write(_whole(_bands(runs), coverage), "runs")

    # Slots: the words of both sides along each shift.
    runs_of = runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_id", "n", "n_windows", "shift", "qs")).alias("runs"))
    ours = split.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), F.col("raw").alias("ours"))
    again = runs_of.join(ours, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
    # Of our words, each run takes its own before runs become rows: the text goes to none of them.
    lo, hi = (lambda r: F.element_at(r["qs"], 1)), (lambda r: F.element_at(r["qs"], -1) + r["n"] - 1)
    cut = lambda r: F.transform(F.sequence(lo(r) + r["shift"], hi(r) + r["shift"]), lambda k: F.get("ours", k))
    own_runs = F.transform("runs", lambda r: F.struct(*(r[c] for c in ("item_id", "n", "n_windows", "shift", "qs")), lo(r).alias("lo"), cut(r).alias("ours")))
    each = again.select("doc_id", "text_hash", F.explode(own_runs).alias("r")).select("doc_id", "text_hash", "r.*")
    # The runs of a text that repeats an item are many; they are checked in all tasks, not in that which read the text.
    both = each.repartition("doc_id", "text_hash", "item_id", "shift").join(items, "item_id")

    def pairs(qs: Column) -> Column:
        """The words that windows at qs cover, on both sides."""
        covered = F.array_distinct(F.flatten(F.transform(qs, lambda q: F.sequence(q, q + F.col("n") - 1))))
        return F.transform(covered, lambda k: F.struct(F.get("words", k).alias("kind"), F.get("raw", k).alias("theirs"), F.get("ours", k - F.col("lo")).alias("ours")))

    slot = lambda x: x["kind"].isin(NUMBER, NAME, UNIT)
    # Where fillers differ too much, windows that are equal word for word still count.
    equal = F.filter("qs", lambda q: F.slice("ours", q - F.col("lo") + 1, F.col("n")) == F.slice("raw", q + 1, F.col("n")))
    slots = lambda qs: F.array_distinct(F.filter(pairs(qs), slot))
    checked = (
        both.withColumn("pairs", pairs(F.col("qs")))
        .withColumn("slots", F.array_distinct(F.filter("pairs", slot)))
        .withColumn("n_plain", F.size(F.filter("pairs", lambda x: ~slot(x))))
        .withColumn("sound", (2 * F.col("n_plain") >= F.size("pairs")) & (F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["kind"], x["theirs"]))))))
        .withColumn("qs", F.when(F.col("sound"), F.col("qs")).otherwise(equal))
        .filter(F.size("qs") > 0)
        .withColumn("slots", F.when(F.col("sound"), F.col("slots")).otherwise(slots(F.col("qs"))))
        .select(*PAIR, "n", "n_windows", "shift", "qs", "slots")
    )
    return (
        _whole(_bands(checked), coverage)
        .groupBy(*PAIR, "n_windows", "band", "n_matched")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("slots")))).alias("n_slots"))
        .groupBy(*PAIR)
        .agg(F.max(F.struct(F.col("n_matched"), F.col("n_windows"), F.col("n_slots"))).alias("best"))
        .select("doc_id", *["text_hash"] * with_hash, "item_id", F.col("best.n_windows").cast("long").alias("n_windows"), F.col("best.n_matched").cast("long").alias("n_matched"), F.col("best.n_slots").cast("long").alias("n_slots"))
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that hold no benchmark item, with their columns."""
    scratch = Scratch(docs.sparkSession, "leaks")
    leaks = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, with_hash=True, **options)
    leaks = scratch.write(leaks.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_key"), F.xxhash64(F.col(text_col).cast("string")).alias("_text"))
    return rows.join(leaks, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_anti").select("_row.*")
