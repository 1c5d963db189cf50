"""Quality rules whose cutoffs carry a guarantee: risk-controlled thresholds per stratum.

Each rule rejects a document whose score is at or above a cutoff. On labelled documents, a cutoff is
certified for a stratum when the exact binomial bound shows that it rejects at most a share
`risk / rules` of the stratum's good documents. Tests of one rule go from the loosest cutoff down and
end at the first that fails, which needs no correction among cutoffs; the error `delta` is split over
all rules and strata. So with confidence 1 - delta, at once in every stratum, all rules together
reject at most a share `risk` of the good. Of the certified cutoffs, the one that best parts bad from
good is used, the loosest of equals. Where labels are too few to certify anything, a rule rejects nothing.

All of it is DataFrame expressions. Texts are read once, in a map; the rest works on one narrow row
per document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let, words_of

# Symbols that count, the least words and the largest share of repeated words.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Cutoffs of a rule are multiples of 1 / LEVELS.
LEVELS = 64

#: Scores in 0..1 by rule, from the metrics.
RULES = {
    "symbols": lambda: F.col("n_symbols") / F.col("n_words"),
    "repeated_words": lambda: F.col("n_repeat_words") / F.col("n_words"),
    "repeated_lines": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "capitals": lambda: F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
}


def _repeated(w: Column) -> Column:
    """Words of w in 3-word windows that occur twice or more in w."""
    zero = F.lit(0).cast("long")

    def covered(starts: Column) -> Column:
        last = F.size(starts) - 1
        return F.aggregate(
            F.sequence(F.lit(0), last),
            zero,
            lambda n, k: n + F.when(k == last, F.lit(3)).otherwise(F.least(F.lit(3), F.get(starts, k + 1) - F.get(starts, k))).cast("long"),
        )

    def sorted_cells(cells: Column) -> Column:
        def same(j: Column, k: Column) -> Column:
            """Hashes bring windows together; that they are the same is told by their words."""
            x, y = F.get(cells, j), F.get(cells, k)
            return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

        again = F.filter(
            F.sequence(F.lit(0), F.size(cells) - 1),
            lambda k: F.coalesce((k > 0) & same(F.greatest(k - 1, F.lit(0)), k), F.lit(False)) | F.coalesce(same(k + 1, k), F.lit(False)),
        )
        return let(F.sort_array(F.transform(again, lambda k: F.get(cells, k)["i"])), lambda p: F.when(F.size(p) == 0, zero).otherwise(covered(p)))

    def windows(g: Column) -> Column:
        word = lambda i, name: F.get(w, i).alias(name)
        cells = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), word(i, "a"), word(i + 1, "b"), word(i + 2, "c"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), zero).otherwise(let(cells, sorted_cells))

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, zero).otherwise(let(hashes, windows))


def metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", with_row: bool = False) -> DataFrame:
    """doc_id, stratum and the counts of each text, in one pass without a shuffle; with_row adds the row itself."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = let(
        words_of(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w).alias("n_repeat_words")),
    )
    lines = let(
        F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(" \t\n\x0b\f\r")) != ""),
        lambda s: F.struct(F.size(s).cast("long").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines")),
    )
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *[F.struct("*").alias("row")] * with_row,
        (F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")).alias("stratum"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        words.alias("w"),
        lines.alias("l"),
    ).select("doc_id", *["row"] * with_row, "stratum", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_upper")


def most_false(n: Column, risk: float, error: Column) -> Column:
    """The most false rejections among n with which a rate above risk is refuted at level error; -1 if none is few enough.

    The binomial distribution function, summed term by term in logarithms from zero rejections up.
    """
    start = F.struct(F.lit(-1).cast("long").alias("k"), F.lit(0.0).alias("sum"), (n * math.log1p(-risk)).alias("log"))

    def step(s: Column, k: Column) -> Column:
        total = s["sum"] + F.exp(s["log"])
        nxt = s["log"] + F.log((n - k).cast("double") / (k + 1)) + math.log(risk / (1 - risk))
        return F.struct(F.when(total <= error, k).otherwise(s["k"]).cast("long").alias("k"), total.alias("sum"), F.coalesce(nxt, F.lit(-1e300)).alias("log"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * risk).cast("long")), start, step)["k"]


def _level(score: Column) -> Column:
    return F.least(F.floor(F.coalesce(score, F.lit(0.0)) * LEVELS).cast("int"), F.lit(LEVELS))


def thresholds(counts: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, id_col: str = "doc_id", good_col: str = "quality") -> DataFrame:
    """stratum and one cutoff level per rule (null: rejects nothing). counts is the output of metrics().

    Labels are one per id: of several, the lowest. Null labels don't count. The histogram is one row
    per stratum, rule and level, whatever the number of labels.
    """
    gold = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(good_col).cast("int").alias("good")).filter("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = counts.filter(~base).join(gold, "doc_id").select("stratum", "good", F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), _level(score()).alias("level")) for name, score in RULES.items()])).alias("r"))
    cells = scored.groupBy("stratum", "r.rule", "r.level").agg(F.count_if(F.col("good") >= 1).alias("good"), F.count_if(F.col("good") < 1).alias("bad"))
    # One row per stratum and rule with its histogram, then the tests in order within the row.
    rows = cells.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), F.map_from_entries(F.collect_list(F.struct("level", F.struct("good", "bad")))).alias("cells"))
    n_strata = rows.groupBy().agg(F.count_distinct("stratum").alias("n")).collect()[0].n
    error = delta / (len(RULES) * max(1, n_strata))

    def test(s: Column, k: Column) -> Column:
        level = F.lit(LEVELS) - k
        cell = F.try_element_at(F.col("cells"), level.cast("int"))
        good, bad = s["good"] + F.coalesce(cell["good"], F.lit(0)), s["bad"] + F.coalesce(cell["bad"], F.lit(0))
        gain = F.coalesce(bad / F.nullif(F.col("n_bad"), F.lit(0)), F.lit(0.0)) - F.coalesce(good / F.nullif(F.col("n_good"), F.lit(0)), F.lit(0.0))
        better = (good <= F.col("allowed")) & (gain > s["gain"])
        return F.struct(
            good.alias("good"),
            bad.alias("bad"),
            F.when(better, gain).otherwise(s["gain"]).alias("gain"),
            F.when(better, level).otherwise(s["cutoff"]).cast("int").alias("cutoff"),
        )

    start = F.struct(F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"), F.lit(0.0).alias("gain"), F.lit(None).cast("int").alias("cutoff"))
    tested = rows.withColumn("allowed", most_false(F.col("n_good"), risk / len(RULES), F.lit(error))).withColumn("cutoff", F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, test)["cutoff"])
    return tested.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(name) for name in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", with_row: bool = False) -> DataFrame:
    """doc_id, the counts, base_failed and kept of each row; with_row adds the row itself.

    Null and empty texts have no words and fail the base rule. A null stratum is a stratum of its
    own. Null ids have no label but are judged; repeated rows are judged each. Without labels, or
    with too few, the base rule alone decides. Texts are read whole, of any length. Equal scores are on
    one side of a cutoff. An empty table gives no rows. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    counts = scratch.write(metrics(docs, id_col, text_col, stratum_col, with_row), "metrics")
    cuts = scratch.write(thresholds(counts, labels, risk, delta, id_col), "thresholds")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    passed = ~base
    for name, score in RULES.items():
        passed = passed & F.coalesce(_level(score()) < F.col(name), F.lit(True))
    return counts.join(cuts, "stratum", "left").select("doc_id", *["row"] * with_row, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), passed.alias("kept"))
