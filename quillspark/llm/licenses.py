"""Licence scans: lines, paragraphs and whole texts compared with licence templates by Dice over word bigrams."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let
from .license_texts import PARAGRAPHS

# Licences by SPDX identifier with the names that notices give them, the wordings of
# notices, and openings of licence texts, all public.
NAMES = [
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("GPL-2.0-only", "GNU General Public License, version 2"),
    ("GPL-3.0-only", "GNU General Public License, version 3"),
    ("LGPL-3.0-only", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0-only", "GNU Affero General Public License, version 3"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("ISC", "ISC License"),
    ("Unlicense", "Unlicense"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
]
WORDINGS = ["Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This work is licensed under {}."]
TEXTS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
]


def templates() -> list[tuple[str, str]]:
    """(licence, text) of all templates: every notice wording with every name, the longer texts, and the paragraphs of licences."""
    return [(spdx, w.format(name)) for spdx, name in NAMES for w in WORDINGS] + TEXTS + PARAGRAPHS


#: What parts words: everything but ASCII letters and digits.
GAP = "[^a-z0-9]+"
#: Blanks that part sentences within a line.
SENTENCE = "(?<=[.!?][\"')\\]]{0,2})[ \t]+"


def _bigrams(words):
    """Distinct word bigrams of an array of words."""
    return F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))
    )


def _words(text):
    bare = F.btrim(F.regexp_replace(F.lower(text), GAP, " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


# Words that any English text has.
FUNCTION_WORDS = frozenset("a about all also an and any are as at be been but by can for from had has have he her his how if in into is it its may more no not of on one or other our out she so some such than that the their them then there these they this to under up was we were what when which who will with would you your".split())


def _needed(n: int, least: float) -> int:
    """Bigrams of a template of n that a unit must share at the very least to reach a Dice coefficient of `least`."""
    return ceil(n * least / (2 - least) - 1e-9)


def key_words(grams: list[list[str]], least: float) -> set[str]:
    """Words such that a unit that reaches `least` with any of the templates holds one of them.

    Of a template's bigrams so many have a key word that a unit without it shares too few. Taken
    greedily: the word that covers most of what is still open for what it costs. Short words cost more
    than long ones, and function words most, as they are in any text.
    """
    at: dict[str, list[tuple[int, str]]] = {}
    for k, some in enumerate(grams):
        for g in some:
            for w in set(g.split(" ")):
                at.setdefault(w, []).append((k, g))
    open_ = [len(some) - _needed(len(some), least) + 1 for some in grams]
    covered, keys = set(), set()
    cost = {w: 10_000 if w in FUNCTION_WORDS else 1 if len(w) > 5 else 8 if len(w) > 4 else 30 for w in at}
    while any(n > 0 for n in open_):

        def gain(w: str) -> float:
            new = Counter(k for k, g in at[w] if (k, g) not in covered)
            return sum(min(n, open_[k]) for k, n in new.items() if open_[k] > 0) / cost[w]

        best = max(sorted(set(at) - keys), key=gain)
        keys.add(best)
        for cell in at[best]:
            if cell not in covered:
                covered.add(cell)
                open_[cell[0]] -= 1
    return keys


def _pattern(words: set[str]) -> str:
    """A regular expression that finds any of words in lower-cased text, as a tree by letters."""

    def tree(some: list[str]) -> str:
        end, rest = "" in some, sorted({w[0] for w in some if w})
        branches = [c + tree([w[1:] for w in some if w[:1] == c]) for c in rest]
        if len(branches) < 2 and not end:
            return "".join(branches)
        return f"(?:{'|'.join(branches)}){'?+' * end}"

    first = "".join(sorted({w[0] for w in words}))
    return f"(?<![a-z0-9])(?=[{first}]){tree(sorted(words))}(?![a-z0-9])"


def license_scan(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", known: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, unit, place, license, dice: the best template of each line, paragraph or text that reaches `least`.

    Units are the lines of a text (unit `line`, place from 0), its paragraphs between blank lines if
    they have more than one line (`paragraph`), the sentences of lines that have several (`sentence`,
    counted over the text's lines of that kind), and the whole text if it has more than one paragraph
    (`text`). Dice is twice the shared distinct bigrams over the sum of both counts, so a template
    of t bigrams needs t * least / (2 - least) to t * (2 - least) / least in the unit; that bound
    prunes templates before their bigrams are compared. Texts and units without a key word (see
    key_words()) can't reach `least` with any template and are left out before they are split into words. Ties go to the licence that sorts
    first. Templates are a list of fixed size, broadcast. A map over partitions until the best of the
    few matches of each unit is taken. Null and empty texts give no rows; a repeated row is scanned once per
    (id, text). Texts are read whole, of any length. An empty table gives no rows, and so do no templates. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = spark.createDataFrame([(k, spdx, text) for k, (spdx, text) in enumerate(known if known is not None else templates())], "template int, license string, body string")
    rows = rows.select("template", "license", _bigrams(_words(F.col("body"))).alias("grams")).filter(F.size("grams") > 0)
    sizes = [r.n for r in rows.select(F.size("grams").alias("n")).collect()]  # of the templates alone
    # A unit that reaches `least` shares so many grams with the template that it holds one of its probes: as many of
    # those with a key word as that takes, first those that the fewest templates have.
    bodies = rows.collect()
    seen = Counter(g for r in bodies for g in r.grams)
    keys = key_words([r.grams for r in bodies], least)
    holds = (lambda text: F.lower(text).rlike(_pattern(keys))) if keys else (lambda text: F.lit(False))
    keyed = [(r.template, len(r.grams), [g for g in r.grams if not keys.isdisjoint(g.split(" "))]) for r in bodies]
    probes = [(k, sorted(some, key=lambda g: (seen[g], -len(g), g))[: n - _needed(n, least) + 1]) for k, n, some in keyed]
    probes = spark.createDataFrame([(k, g) for k, some in probes for g in some], "template int, gram string")
    rows = rows.select("license", "template", F.size("grams").alias("t"), F.col("grams").alias("theirs"))
    # Runs of sizes that some template allows.
    spans: list[list[int]] = []
    for n in sorted(set(sizes)):
        lo, hi = -int(-(n * least / (2 - least)) // 1), int(n * (2 - least) / least)
        if spans and lo <= spans[-1][1] + 1:
            spans[-1][1] = max(hi, spans[-1][1])
        else:
            spans.append([lo, hi])
    allowed = lambda n: reduce(lambda a, b: a | b, [n.between(lo, hi) for lo, hi in spans], F.lit(False))
    longest = max((hi for _, hi in spans), default=0)

    lines = F.split("text", "\n")
    paragraphs = F.split("text", "\n[ \t]*\n")
    empty = F.array().cast("array<string>")
    sentences = F.flatten(F.transform(F.filter(lines, lambda s: s.rlike(f"{SENTENCE}[^ \t]")), lambda s: F.split(s, SENTENCE)))
    units = F.concat(
        F.transform(lines, lambda s, k: F.struct(F.lit("line").alias("unit"), k.cast("long").alias("place"), s.alias("body"))),
        F.transform(sentences, lambda s, k: F.struct(F.lit("sentence").alias("unit"), k.cast("long").alias("place"), s.alias("body"))),
        F.transform(F.when(F.col("text").contains("\n"), paragraphs).otherwise(empty), lambda s, k: F.struct(F.when(s.contains("\n"), "paragraph").alias("unit"), k.cast("long").alias("place"), s.alias("body"))),
        F.when(F.size(paragraphs) > 1, F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).cast("long").alias("place"), F.col("text").alias("body")))).otherwise(F.array()),
    )
    # A unit of more than so many bytes holds more words than any template allows, unless they repeat:
    # bigrams are distinct, so length alone prunes only from below.
    shortest = min((lo for lo, _ in spans), default=1) * 2 + 1
    found = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .filter(holds(F.col("text")))
        .select("doc_id", F.explode(units).alias("u"))
        .select("doc_id", "u.unit", "u.place", "u.body")
        .filter(F.col("unit").isNotNull() & (F.octet_length("body") >= shortest))
        .filter(holds(F.col("body")))
        .select("doc_id", "unit", "place", F.xxhash64("body").alias("body_hash"), let(_words(F.col("body")), lambda w: _bigrams(w)).alias("grams"))
        .withColumn("n", F.size("grams"))
        .filter(allowed(F.col("n")) & (F.col("n") <= longest))
        # Probes whose grams the unit holds; of the pairs that are left, all grams are compared.
        .select("doc_id", "unit", "place", "body_hash", "n", "grams", F.explode("grams").alias("gram"))
        .join(F.broadcast(probes), "gram")
        .join(F.broadcast(rows), "template")
        .filter((F.col("n") >= F.col("t") * (least / (2 - least))) & (F.col("n") <= F.col("t") * ((2 - least) / least)))
        .withColumn("shared", F.size(F.array_intersect("grams", "theirs")))
    )
    return (
        found
        .withColumn("dice", 2.0 * F.col("shared") / (F.col("n") + F.col("t")))
        .filter(F.col("dice") >= least)
        .groupBy("doc_id", "unit", "place", "body_hash")
        .agg(F.min(F.struct((-F.col("dice")).alias("order"), "license", "template")).alias("best"))
        .select("doc_id", "unit", "place", F.col("best.license").alias("license"), F.round(-F.col("best.order"), 6).alias("dice"))
    )
