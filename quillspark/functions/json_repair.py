"""Recovery of JSON from model output: strict, then fenced, then a valid prefix, then closing what was cut off.

All of it is expressions: brackets and strings are followed by a stack machine, a fold over those
characters of a text that can matter, and candidates are parsed as variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binding import let

FENCE, LANGUAGE = "```", "json"
#: Blanks at the ends of a text, Unicode's and the separators of ASCII.
BLANK = "(?U)[\\s\\x1c-\\x1f]"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def strict(text: Column) -> Column:
    """text as a variant if it is one JSON value and nothing more, else null.

    The parser stops behind the first value. What follows a value may close an array around it, or an
    object, but not both; so both must parse, the array with one element.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    one = lambda v: F.when(alone & F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant"))
    return let(listed, one)


def _state(stack: Column, inside: Column, skip: Column, end: Column) -> Column:
    return F.struct(stack.cast("string").alias("stack"), inside.cast("boolean").alias("inside"), skip.cast("boolean").alias("skip"), end.cast("int").alias("end"))


def brackets(text: Column) -> Column:
    """stack (what closes the open brackets, innermost first), inside (a string is open) and end, of a text that begins with a bracket.

    end counts the characters up to where the first bracket is closed; 0 if it never is. A closing
    bracket that doesn't fit the innermost open one is passed over.
    """

    def fold(chars: Column) -> Column:
        matters = lambda k: F.get(chars, k).isin('"', "\\", "{", "}", "[", "]") | F.coalesce((k > 0) & (F.get(chars, F.greatest(k - 1, F.lit(0))) == "\\"), F.lit(False))

        def step(s: Column, k: Column) -> Column:
            def one(c: Column) -> Column:
                popped = F.substring(s["stack"], 2, 1 << 30)
                closes = (s["stack"] != "") & (c == F.substring(s["stack"], 1, 1))
                no, yes = F.lit(False), F.lit(True)
                return (
                    F.when(s["end"] > 0, s)
                    .when(s["skip"], _state(s["stack"], s["inside"], no, s["end"]))
                    .when(s["inside"] & (c == "\\"), _state(s["stack"], yes, yes, s["end"]))
                    .when(c == '"', _state(s["stack"], ~s["inside"], no, s["end"]))
                    .when(s["inside"], s)
                    .when(c == "{", _state(F.concat(F.lit("}"), s["stack"]), no, no, s["end"]))
                    .when(c == "[", _state(F.concat(F.lit("]"), s["stack"]), no, no, s["end"]))
                    .when(closes, _state(popped, no, no, F.when(popped == "", k + 1).otherwise(0)))
                    .otherwise(s)
                )

            return let(F.get(chars, k), one)

        return F.aggregate(F.filter(F.sequence(F.lit(0), F.size(chars) - 1), matters), _state(F.lit(""), F.lit(False), F.lit(False), F.lit(0)), step)

    return let(F.split(text, ""), fold)


def closed(text: Column, state: Column) -> Column:
    """text with its open string and brackets closed, and blanks and commas before these dropped; state is brackets(text)."""
    whole = F.when(state["inside"], F.concat(text, F.lit('"'))).otherwise(text)
    return F.concat(F.rtrim(F.regexp_replace(whole, f"{BLANK}+$", ""), F.lit(",")), state["stack"])


def recovered(text: Column) -> Column:
    """value (a variant, null where nothing recovers it) and note, how it was found.

    Notes: empty for strict JSON, unfenced, trimmed (a valid beginning), repaired_truncated, empty_response,
    no_json_object, unparseable:no_valid_json. A key that repeats in an object is no valid JSON, unless the session sets
    spark.sql.variant.allowDuplicateKeys; nor are NaN and Infinity.
    """
    out = lambda value, note: F.struct(value.alias("value"), F.lit(note).alias("note"))
    none = lambda note: out(F.lit(None).cast("variant"), note)

    def tried(value: Column, note: str, otherwise: Column) -> Column:
        return let(value, lambda v: F.when(v.isNotNull(), out(v, note)).otherwise(otherwise))

    def opened(rest: Column) -> Column:
        bad = none("unparseable:no_valid_json")
        cut = lambda s: F.when(s["end"] > 0, tried(F.try_parse_json(F.substring(rest, F.lit(1), s["end"])), "trimmed", bad)).otherwise(tried(F.try_parse_json(closed(rest, s)), "repaired_truncated", bad))
        return F.when(rest == "", none("no_json_object")).otherwise(let(brackets(rest), cut))

    def unfenced(bare: Column) -> Column:
        first = F.locate(FENCE, bare)
        after = F.substring(bare, first + len(FENCE), F.length(bare))
        body = F.regexp_replace(F.substring(after, F.lit(1), F.locate(FENCE, after) - 1), f"^{LANGUAGE}", "")
        inner = F.when((first > 0) & (F.locate(FENCE, after) > 0), _stripped(body))
        rest = lambda i: let(F.regexp_extract(F.coalesce(i, bare), "(?s)[{\\[].*", 0), opened)
        return let(inner, lambda i: tried(strict(i), "unfenced", rest(i)))

    return let(_stripped(F.coalesce(text, F.lit(""))), lambda bare: F.when(bare == "", none("empty_response")).otherwise(tried(strict(bare), "", unfenced(bare))))


def with_json(df: DataFrame, text_col: str = "text", value_col: str = "value", note_col: str = "parse_note") -> DataFrame:
    """df with the recovered value as a variant and the note; a value that nothing recovers is null."""
    staged = df.withColumn("_found", recovered(F.col(text_col)))
    return staged.select(*df.columns, F.col("_found.value").alias(value_col), F.col("_found.note").alias(note_col))


def expand_rows(value: Column, columns: list[str]) -> Column:
    """An array variant of positional rows or objects, as an array of maps from column to JSON text.

    Short rows are padded with null and long ones cut; objects pass through; scalars go. In
    positional rows struck_through becomes a boolean by truthiness.
    """
    rows = F.from_json(F.to_json(value), "array<string>")

    def one(row: Column) -> Column:
        kinds = F.try_parse_json(row)
        pairs = []
        for k, name in enumerate(columns):
            cell = F.to_json(F.try_variant_get(kinds, f"$[{k}]", "variant"))
            if name == "struck_through":
                false = cell.isNull() | cell.isin("null", "0", "0.0", '""', "false", "[]", "{}")
                cell = F.when(false, "false").otherwise("true")
            pairs.append(F.struct(F.lit(name).alias("k"), F.coalesce(cell, F.lit("null")).alias("v")))
        body = F.array_join(F.transform(F.array(*pairs), lambda p: F.concat(F.lit('"'), p["k"], F.lit('":'), p["v"])), ",")
        return F.when(row.startswith("["), F.concat(F.lit("{"), body, F.lit("}"))).when(row.startswith("{"), row)

    return F.filter(F.transform(rows, one), lambda r: r.isNotNull())
